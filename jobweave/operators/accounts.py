"""Account requests as table jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import DEFAULT_THRESHOLD, registration_reasons, update_reasons
from .ranking import first_per_group

PROFILE_COLUMNS = ("user_id", "email", "name", "score_threshold", "enabled_sources", "verified")
PATCH_COLUMNS = ("name", "profile_text", "score_threshold", "enabled_sources", "notification_email")


def validate_registrations(requests: DataFrame) -> DataFrame:
    """Add `reasons`, the broken rules of each request (empty when valid)."""
    threshold = F.coalesce("score_threshold", F.lit(DEFAULT_THRESHOLD))
    return requests.withColumn("reasons", registration_reasons(threshold))


def validate_updates(changes: DataFrame, known_sources: DataFrame, key: str = "user_id") -> DataFrame:
    """Add `unknown` (requested sources that do not exist) and `reasons` to partial updates.

    `key` identifies a change. Requested names are checked by an equi-join on the name.
    """
    names = changes.select(key, F.explode(F.array_distinct("enabled_sources")).alias("source_id"))
    unknown = (
        names.join(known_sources.select("source_id"), "source_id", "left_anti")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list("source_id")).alias("unknown"))
    )
    none = F.array().cast("array<string>")
    return (
        changes.join(unknown, key, "left")
        .withColumn("unknown", F.coalesce("unknown", none))
        .withColumn("reasons", update_reasons(F.col("unknown")))
    )


def registration_status(requests: DataFrame, users: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `status`: 'invalid', 'conflict' (address already registered), 'duplicate' (an earlier valid
    request of the batch has the address) or 'accepted'.

    `order` is a unique request sequence. The first request per address is an aggregate.
    """
    checked = validate_registrations(requests)
    valid = F.size("reasons") == 0
    seq = F.struct(*order)
    firsts = checked.filter(valid).groupBy("email").agg(F.min(seq).alias("_first"))
    taken = users.filter(F.col("email").isNotNull()).select("email").distinct().withColumn("_taken", F.lit(True))
    # Invalid requests may share one bad or missing address; they are kept out of the join.
    first_taken = firsts.join(taken, "email", "left")
    status = (
        F.when(F.coalesce("_taken", F.lit(False)), "conflict")
        .when(seq > F.col("_first"), "duplicate")
        .otherwise("accepted")
    )
    judged = checked.filter(valid).join(first_taken, "email").withColumn("status", status)
    refused = checked.filter(~valid).withColumn("status", F.lit("invalid"))
    columns = [*requests.columns, "reasons", "status"]
    return judged.select(*columns).unionByName(refused.select(*columns))


def new_accounts(
    requests: DataFrame, users: DataFrame, order: Sequence[str], default_sources: Sequence[str], created_at: Column
) -> DataFrame:
    """Rows to append to the users: unverified, mail to the registration address."""
    sources = F.array(*[F.lit(s) for s in default_sources]).cast("array<string>")
    accepted = registration_status(requests, users, order).filter("status = 'accepted'")
    return accepted.select(
        "user_id",
        "email",
        "name",
        "profile_text",
        F.coalesce("score_threshold", F.lit(DEFAULT_THRESHOLD)).alias("score_threshold"),
        F.coalesce("enabled_sources", sources).alias("enabled_sources"),
        F.col("email").alias("notification_email"),
        F.lit(False).alias("verified"),
        "verification_token",
        created_at.alias("created_at"),
    )


def verify_accounts(users: DataFrame, tokens: DataFrame) -> DataFrame:
    """New snapshot: users whose token was presented are verified and lose it."""
    presented = tokens.select("verification_token").filter(F.col("verification_token").isNotNull())
    pending = users.filter(F.col("verification_token").isNotNull())
    others = users.filter(F.col("verification_token").isNull())
    hits = presented.distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    checked = (
        pending.join(hits, "verification_token", "left")
        .withColumn("verified", hit | F.col("verified"))
        .withColumn("verification_token", F.when(~hit, F.col("verification_token")))
    )
    return checked.select(*users.columns).unionByName(others)


def profile_view(users: DataFrame) -> DataFrame:
    return users.select(*PROFILE_COLUMNS)


def patch_profiles(
    users: DataFrame, changes: DataFrame, order: Sequence[Column], updated_at: Column
) -> DataFrame:
    """New snapshot: the latest change per user replaces the fields it gives (non-null)."""
    latest = first_per_group(changes, ["user_id"], order)
    given = [F.col(c).alias(f"_{c}") for c in PATCH_COLUMNS if c in changes.columns]
    joined = users.join(latest.select("user_id", *given, F.lit(True).alias("_changed")), "user_id", "left")
    updates = {c: F.coalesce(f"_{c}", c) for c in PATCH_COLUMNS if c in changes.columns}
    stamp = F.when(F.col("_changed"), updated_at).otherwise(F.col("updated_at"))
    return joined.withColumns({**updates, "updated_at": stamp}).select(*users.columns)


def resolve_identities(requests: DataFrame, users: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add `user_id` and `resolved_by` ('id', 'email' or null): by claimed id, else by e-mail.

    Requests that need no second lookup, or have no address for one, get a key of their own there
    that no account has, so they do not gather on one null key.
    """
    ids = users.select(F.col("user_id").alias("claim_id"), F.lit(True).alias("_hit"))
    mails = first_per_group(users.filter(F.col("email").isNotNull()), ["email"], order).select(
        F.col("email").alias("_key"), F.col("user_id").alias("_by_mail")
    )
    has_mail = F.coalesce(F.col("email") != "", F.lit(False))
    private = F.concat(F.lit("\x00"), F.xxhash64(*requests.columns).cast("string"))
    key = F.when(F.col("_hit").isNull() & has_mail, F.col("email")).otherwise(private)
    return (
        requests.join(ids, "claim_id", "left")
        .withColumn("_key", key)
        .join(mails, "_key", "left")
        .select(
            *requests.columns,
            F.when(F.col("_hit"), F.col("claim_id")).otherwise(F.col("_by_mail")).alias("user_id"),
            F.when(F.col("_hit"), "id").when(F.col("_by_mail").isNotNull(), "email").alias("resolved_by"),
        )
    )
