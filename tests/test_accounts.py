from pyspark.sql import functions as F

from fixtures import keys, registry, users
from jobweave.operators import accounts

REQUEST = "request_id int, user_id string, email string, name string, profile_text string, score_threshold int, enabled_sources array<string>, verification_token string"
TEXT = "A profile text of more than twenty characters."


def requests(spark, rows):
    return spark.createDataFrame(rows, REQUEST)


def test_registration_outcomes(spark):
    rows = requests(
        spark,
        [
            (1, "n1", "new@example.com", "New", TEXT, None, None, "t1"),
            (2, "n2", "new@example.com", "Again", TEXT, 8, ["second"], "t2"),
            (3, "n3", "ines@mail.example", "Ines", TEXT, 7, ["board"], "t3"),
            (4, "n4", "bad address@example.com", "Bad", "Too short", 0, None, "t4"),
            (5, "n5", None, None, None, 11, None, "t5"),
        ],
    )
    status = accounts.registration_status(rows, users(spark), ["request_id"])
    assert {r.request_id: (r.status, r.reasons) for r in status.collect()} == {
        1: ("accepted", []),
        2: ("duplicate", []),
        3: ("conflict", []),
        4: ("invalid", ["email", "profile_text", "score_threshold"]),
        5: ("invalid", ["email", "name", "profile_text", "score_threshold"]),
    }
    (created,) = accounts.new_accounts(rows, users(spark), ["request_id"], ["board"], F.lit("now")).collect()
    assert (created.user_id, created.score_threshold, created.enabled_sources, created.verified, created.notification_email) == (
        "n1", 7, ["board"], False, "new@example.com",
    )


def test_length_bounds(spark):
    rows = requests(spark, [(n, "u", "a@b.c", "n" * n, "p" * p, 7, None, "t") for n, p in ((1, 20), (120, 10_000), (121, 10_001), (0, 19))])
    found = {r.request_id: r.reasons for r in accounts.validate_registrations(rows).collect()}
    assert found == {1: [], 120: [], 121: ["name", "profile_text"], 0: ["name", "profile_text"]}


def changes(spark, rows):
    return spark.createDataFrame(rows, "user_id string, name string, profile_text string, score_threshold int, enabled_sources array<string>, seq int")


def test_name_only_patch_leaves_the_rest(spark):
    batch = changes(spark, [("ines", "Alicia", None, None, None, 1), ("ines", "Al", None, None, None, 0)])
    patched = accounts.patch_profiles(users(spark), batch, [F.desc("seq")], F.lit("now"))
    before = {r.user_id: r for r in users(spark).collect()}
    for row in patched.collect():
        old = before[row.user_id].asDict()
        new = {"name": "Alicia", "updated_at": "now"} if row.user_id == "ines" else {}
        assert row.asDict() == {**old, **new}


def test_unknown_sources_are_refused(spark):
    batch = changes(spark, [("a", None, None, None, ["board", "zz", "aa", "zz"], 1), ("b", None, None, None, [], 1), ("c", None, "short", 11, None, 1)])
    checked = {r.user_id: (r.unknown, r.reasons) for r in accounts.validate_updates(batch, registry(spark)).collect()}
    assert checked == {"a": (["aa", "zz"], ["enabled_sources"]), "b": ([], []), "c": ([], ["profile_text", "score_threshold"])}


def test_tokens_verify_once(spark):
    tokens = spark.createDataFrame([("token-vera",), ("token-vera",), ("other",), (None,)], "verification_token string")
    after = {r.user_id: (r.verified, r.verification_token) for r in accounts.verify_accounts(users(spark), tokens).collect()}
    assert after == {"ines": (True, None), "tomo": (True, None), "vera": (True, None)}


def test_identity_by_id_then_by_address(spark):
    claims = spark.createDataFrame(
        [(1, "ines", "tomo@mail.example"), (2, "sub", "tomo@mail.example"), (3, "sub", "x@example.com"), (4, None, None), (5, None, "")],
        "request_id int, claim_id string, email string",
    )
    found = accounts.resolve_identities(claims, users(spark), [F.col("user_id")])
    assert keys(found, "request_id", "user_id", "resolved_by") == {
        (1, "ines", "id"), (2, "tomo", "email"), (3, None, None), (4, None, None), (5, None, None),
    }
