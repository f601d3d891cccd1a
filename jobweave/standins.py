"""The engine's tables, derived from the star-schema tables of a data folder.

parts are postings, brands are boards, customers are users, line items are evaluations and sightings,
orders are account requests. Every table keeps all rows of its inputs. Some values are blank, null or
malformed by rule, so that defaults and rejections are exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SOURCES = ("Brand#1",)
BASE_URL = "https://jobs.example.org"
PRODUCT = "Match Mail"
RUN_AT = "2025-02-01T08:00:00"
SECOND_CRAWL = 1998  # the year from which line items arrive in a second batch
AS_OF = "2025-01-20"
PROFILE = "Somebody who reads and writes long texts"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _choose(number: Column, n: int, cases: dict[int, Column | None], otherwise: Column) -> Column:
    """A value by `number % n`; None stands for null."""
    expr = None
    for rest, value in cases.items():
        value = F.lit(None).cast("string") if value is None else value
        expr = F.when(number % n == rest, value) if expr is None else expr.when(number % n == rest, value)
    return expr.otherwise(otherwise)


def posting_fields(key: Column, size: Column) -> dict[str, Column]:
    """Fields of a part as a posting, from its key, name, type, brand and size."""
    day = F.date_add(F.lit("2025-01-01").cast("date"), size)
    return {
        "job_id": key.cast("string"),
        "source_id": F.col("p_brand"),
        "title": _choose(key, 40, {7: F.lit(""), 23: None}, F.col("p_name")),
        "location": _choose(size, 7, {0: F.lit("")}, F.concat(F.lit("City "), size.cast("string"))),
        "contract_type": _choose(
            size, 4, {0: F.lit("Staff"), 1: F.lit("PERMANENT"), 2: F.lit("Short-Term")}, F.col("p_type")
        ),
        "deadline": _choose(
            key,
            10,
            {
                0: F.lit(""),
                1: None,
                2: F.lit("open until filled"),
                3: F.date_format(day, "yyyy-M-d"),
                4: F.date_format(day, "yyyy-MM-dd'T00:00:00'"),
            },
            F.date_format(day, "yyyy-MM-dd"),
        ),
        "description_raw": _choose(
            key, 9, {4: F.lit("")}, F.concat_ws(" ", "p_type", "p_name", F.lit("at"), "p_brand")
        ),
        "url": _choose(key, 15, {8: F.lit("")}, F.concat(F.lit(f"{BASE_URL}/vacancy/"), key.cast("string"))),
    }


def _second_board() -> Column:
    """The other board that has a posting with the same id, for some parts."""
    return F.concat(F.lit("Brand#"), (F.substring_index("p_brand", "#", -1).cast("int") % 25 + 1).cast("string"))


def _on_two_boards(key: Column) -> Column:
    return key % 50 == 3


def _as_postings(parts: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    seen_at = F.timestamp_seconds(F.lit(1704067200) + key * 60)
    fields = {**posting_fields(key, F.col("p_size")), "scraped_at": F.date_format(seen_at, "yyyy-MM-dd'T'HH:mm:ss")}
    return parts.select(*[c.alias(n) for n, c in fields.items()])


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as postings; some ids are those of postings on two boards."""
    parts = table(spark, folder, "part")
    again = parts.filter(_on_two_boards(F.col("p_partkey"))).withColumn("p_brand", _second_board())
    return _as_postings(parts).unionByName(_as_postings(again))


def legacy_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Single-user store: no board, and a time stamp instead of text (null for some)."""
    stamp = F.to_timestamp("scraped_at")
    missing = F.col("job_id").cast("long") % 21 == 5
    return _as_postings(table(spark, folder, "part")).withColumn("scraped_at", F.when(~missing, stamp)).drop("source_id")


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")

    def brand(number: Column) -> Column:
        return F.concat(F.lit("Brand#"), (number % 25 + 1).cast("string"))

    profile = F.concat(F.lit("Professional in "), F.lower("c_mktsegment"), F.lit(" with customer number "), text)
    sources = F.when(key % 19 == 0, F.lit(None)).when(key % 19 == 1, F.array().cast("array<string>"))
    verified = F.col("c_acctbal") > 0
    fields = {
        "user_id": text,
        "email": F.when(key % 23 != 5, F.concat(F.lit("c"), text, F.lit("@example.org"))),
        "name": _choose(key, 29, {3: F.lit("")}, F.when(key % 31 != 4, F.col("c_name"))),
        "profile_text": _choose(key, 13, {0: F.lit(""), 1: F.lit(" \t ")}, F.when(key % 17 != 2, profile)),
        "score_threshold": F.when(key % 11 != 0, (F.lit(5) + key % 5).cast("int")),
        "enabled_sources": sources.otherwise(F.array(brand(key), brand(key * 7 + 3))),
        "notification_email": _choose(
            key, 3, {0: None, 1: F.lit("")}, F.concat(F.lit("notify"), text, F.lit("@example.org"))
        ),
        "verified": verified,
        "verification_token": F.when(~verified, F.concat(F.lit("token-"), text)),
        "created_at": F.lit("2024-06-01T00:00:00"),
        "updated_at": F.lit(None).cast("string"),
    }
    return table(spark, folder, "customer").select(*[c.alias(n) for n, c in fields.items()])


def evaluation_log(spark: SparkSession, folder: str) -> DataFrame:
    """All evaluations ever written; (user_id, source_id, job_id) repeats."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    score = (
        F.when(number == 7, 0)
        .when((number == 5) & (quantity > 45), F.lit(None))
        .otherwise((quantity.cast("int") - 1) % 10 + 1)
    )
    sent = F.when((number == 4) & (quantity > 48), F.lit(None)).otherwise(F.col("l_returnflag") == "R")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    second = _on_two_boards(F.col("l_partkey")) & (number % 2 == 1)
    return lines.join(orders, "l_orderkey").join(parts, "l_partkey").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(second, _second_board()).otherwise(F.col("p_brand")).alias("source_id"),
        F.col("l_partkey").cast("string").alias("job_id"),
        score.cast("int").alias("score"),
        F.concat(F.lit("Line "), F.col("l_orderkey").cast("string"), F.lit("/"), number.cast("string")).alias("summary"),
        sent.alias("email_sent"),
        F.col("l_shipdate").cast("timestamp").alias("evaluated_at"),
        F.col("l_orderkey").alias("seq"),
        number.alias("line"),
    )


def newest_first() -> list[Column]:
    """Total order of the evaluation log per key."""
    return [
        F.desc("evaluated_at"),
        F.desc("seq"),
        F.desc("line"),
        F.desc_nulls_last("score"),
        F.desc_nulls_last("email_sent"),
    ]


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    """Postings as found by crawls, many times each; unreturned lines stand for postings not stored yet."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    new = F.col("l_returnflag") == "N"
    key = F.col("p_partkey") + F.when(new, 1_000_000_000).otherwise(0)
    fields = {
        **posting_fields(key, F.col("p_size")),
        "title": F.concat(F.col("p_name"), F.lit(" v"), F.col("l_linenumber").cast("string")),
        "scraped_at": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"),
    }
    return lines.join(parts, "p_partkey").select(
        *[c.alias(n) for n, c in fields.items()],
        F.col("l_orderkey").alias("seq"),
        F.col("l_linenumber").alias("line"),
    )


def crawl_order(newest: bool) -> list[Column]:
    pick = F.desc if newest else F.asc
    return [pick("scraped_at"), pick("seq"), pick("line")]


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One board per brand, with gaps that the registry's defaults fill."""
    number = F.substring_index("p_brand", "#", -1).cast("int")
    n = F.col("n")
    text = n.cast("string")
    words = F.array(*[F.lit(w) for w in ("ring", "Hot", "LARGE", "bolt", "old w", "gear")])
    brands = table(spark, folder, "part").select("p_brand").distinct().withColumn("n", number)
    return brands.select(
        F.col("p_brand").alias("source_id"),
        F.when(n % 5 != 0, F.concat(F.lit("Board "), text, F.lit(" (B"), text, F.lit(")"))).alias("display_name"),
        F.when(n % 3 != 0, F.concat(F.lit("Board"), text)).alias("label"),
        F.when(n % 7 != 0, n % 4 != 3).alias("enabled"),
        F.when(n % 5 != 1, n % 6 == 0).alias("enabled_by_default"),
        F.concat(F.lit(f"{BASE_URL}/"), text).alias("base_url"),
        F.when(n % 3 != 0, F.concat(F.lit("#0000"), F.lpad(text, 2, "0"))).alias("color"),
        F.array(F.get(words, n % 6), F.get(words, (n + 2) % 6)).alias("search_keywords"),
    )


def account_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Registrations: some addresses are taken, repeated or malformed."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    interest = F.concat(F.lit("Interested in orders of priority "), F.col("o_orderpriority"))
    mail = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("c"), customer)).otherwise(
        F.concat(F.lit("new"), customer)
    )
    return table(spark, folder, "orders").select(
        key.alias("request_id"),
        F.concat(F.lit("acc-"), key.cast("string")).alias("user_id"),
        _choose(key, 17, {3: F.lit("no address"), 4: None}, F.concat(mail, F.lit("@example.org"))).alias("email"),
        _choose(key, 19, {2: F.lit(""), 5: F.repeat(F.lit("n"), 121)}, F.concat(F.lit("Person "), customer)).alias("name"),
        _choose(key, 23, {1: F.lit("Too short")}, interest).alias("profile_text"),
        F.when(key % 13 != 6, (key % 12).cast("int")).alias("score_threshold"),
        F.when(key % 4 != 1, F.array(F.concat(F.lit("Brand#"), (key % 30 + 1).cast("string")))).alias("enabled_sources"),
        F.concat(F.lit("verify-"), key.cast("string")).alias("verification_token"),
    )


def profile_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Partial updates; fields left out are null."""
    key = F.col("o_orderkey")
    profile = F.concat(F.lit("A new profile from order "), key.cast("string"))
    return table(spark, folder, "orders").select(
        key.alias("request_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(key % 3 == 0, F.concat(F.lit("Renamed "), key.cast("string"))).alias("name"),
        F.when(key % 4 == 0, _choose(key, 8, {0: F.lit("short text")}, profile)).alias("profile_text"),
        F.when(key % 5 == 0, (key % 14).cast("int")).alias("score_threshold"),
        F.when(
            key % 2 == 0,
            F.array(
                F.concat(F.lit("Brand#"), (key % 25 + 1).cast("string")),
                F.concat(F.lit("Brand#"), (key % 40 + 1).cast("string")),
            ),
        ).alias("enabled_sources"),
        F.when(key % 6 == 0, F.concat(F.lit("n"), key.cast("string"), F.lit("@example.org"))).alias("notification_email"),
    )


def identity_claims(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that name an account by id (sometimes unknown) and, often, by address."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        key.alias("request_id"),
        F.when(key % 3 == 0, customer).otherwise(F.concat(F.lit("sub-"), customer)).alias("claim_id"),
        _choose(key, 5, {1: None, 2: F.lit("")}, F.concat(F.lit("c"), customer, F.lit("@example.org"))).alias("email"),
    )


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Scorer answers in all the shapes a text model gives, one per line item, and error messages."""
    line = table(spark, folder, "lineitem")
    number = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    score = F.col("l_quantity").cast("int") % 13
    text = F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))

    def answer(value: Column, tail: str = "") -> Column:
        return F.concat(F.lit('{"score": '), value, F.lit(', "summary": "'), text, F.lit('"}' + tail))

    digits = score.cast("string")
    shapes = {
        0: F.concat(F.lit("```json\n"), answer(digits), F.lit("\n```")),
        1: answer(F.concat(F.lit('"'), digits, F.lit('"'))),
        2: answer(F.concat(digits, F.lit(".7"))),
        3: answer(F.concat(F.lit('"'), digits, F.lit('.7"'))),
        4: answer(digits, " Hope this helps!"),
        5: F.concat(F.lit('{"score": '), digits, F.lit("}")),
        6: F.lit("I cannot rate this."),
        7: F.lit(""),
        8: answer(F.lit("true")),
        9: answer(F.lit("null")),
        10: F.concat(F.lit("  \n```\n"), answer(digits), F.lit("```  ")),
        11: F.concat(F.lit('{"summary": "'), text, F.lit('"}')),
    }
    messages = {
        0: F.lit("429 PerDay limit used up"),
        1: F.lit("429 Too Many Requests"),
        2: F.lit("Quota exceeded"),
        3: F.lit("could not generate text"),
        4: F.lit("limit_per_DAY reached"),
        5: None,
        6: F.lit("Rate limit"),
    }
    return line.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
        _choose(number, 16, shapes, answer(digits)).alias("response"),
        _choose(number, 9, messages, F.lit("connection reset")).alias("message"),
    )


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    """One run per day of events."""
    day = F.to_date("ts")
    kind = F.col("event_type")
    grouped = table(spark, folder, "events").groupBy(day.alias("day")).agg(
        F.min("ts").alias("run_at"),
        F.count(F.lit(1)).alias("jobs_in_db"),
        F.count_if((kind == "signup") & (F.col("value") > 40)).alias("new_jobs"),
        F.count_if(kind == "view").alias("evaluated"),
        F.count_if(kind == "purchase").alias("emails_sent"),
        F.count_if(kind == "error").alias("n_errors"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
    )
    number = F.dayofmonth("day")
    return grouped.select(
        F.col("run_at").cast("timestamp").alias("run_at"),
        F.when(number % 5 == 0, "manual").otherwise("scheduled").alias("trigger"),
        "jobs_in_db",
        F.when(number % 6 != 0, F.col("new_jobs")).otherwise(F.lit(0)).alias("new_jobs"),
        "evaluated",
        "emails_sent",
        F.when(number % 7 != 0, F.when(number % 3 == 0, F.col("total") % 60).otherwise(F.col("total"))).alias("duration_s"),
        F.when(F.col("n_errors") % 4 == 0, "failed").otherwise("ok").alias("status"),
        F.concat(F.lit("day "), number.cast("string")).alias("notes"),
    )


def document_postings(spark: SparkSession, folder: str) -> DataFrame:
    """Postings with long texts: the documents, whole."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.col("source").alias("source_id"),
        F.concat_ws(" ", F.lit("Text in"), "lang").alias("title"),
        F.when(F.col("doc_id") % 6 != 2, F.concat(F.lit("Site "), F.col("source"))).alias("location"),
        F.lit(None).cast("string").alias("contract_type"),
        F.lit("").alias("deadline"),
        F.col("text").alias("description_raw"),
        F.concat(F.lit(f"{BASE_URL}/doc/"), F.col("doc_id").cast("string")).alias("url"),
    )


def search_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Search-result pages as JSON, fifty postings each; a repeated title column and blank ids occur."""
    key = F.col("p_partkey")

    def cell(name: str, value: Column, html: Column | None = None) -> Column:
        markup = F.lit(None).cast("string") if html is None else html
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), markup.alias("html"))

    # Three spellings of a link, as boards deliver them.
    href = F.concat(F.lit("/vacancy/"), key.cast("string"), F.lit("?a=1&b=2"))
    escaped = F.replace(F.replace(href, F.lit("="), F.lit("\\u003d")), F.lit("&"), F.lit("\\u0026"))
    link = _choose(
        key,
        3,
        {
            0: F.concat(F.lit('<a href="'), href, F.lit('">x</a>')),
            1: F.concat(F.lit('<a href=\\"'), escaped, F.lit('\\">x</a>')),
        },
        F.concat(F.lit('<a class="c" href="https://other.example.net/'), key.cast("string"), F.lit('">x</a>')),
    )
    columns = F.array(
        cell("title", F.lit("overridden")),
        cell("job_posting_ref", F.when(key % 33 != 9, key.cast("string")).otherwise(""), link),
        cell("title", F.col("p_name")),
        cell("location", F.when(key % 8 != 3, F.concat(F.lit("City "), F.col("p_size").cast("string")))),
        cell("job_type_text", F.col("p_type")),
    )
    # A page is bounded: fifty consecutive keys.
    return (
        table(spark, folder, "part")
        .groupBy(F.floor(key / 50).alias("page_no"))
        .agg(F.collect_list(F.struct(columns.alias("columns"))).alias("rows"))
        .select("page_no", F.to_json(F.struct("rows")).alias("payload"))
    )


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing tables in HTML, fifty postings each; some rows are short and some links have no text."""
    key = F.col("p_partkey")

    def cell(value: Column) -> Column:
        return F.concat(F.lit("<td class=x> "), value, F.lit("\n</td>"))

    number = F.when(key % 33 != 9, key.cast("string")).otherwise("")
    link = F.concat(
        F.lit('<td><a class="archiveLink big" href="/v/'), key.cast("string"), F.lit('?a=1&amp;b=2"><b>'), number,
        F.lit("</b></a></td>"),
    )
    day = F.concat(F.lit("2025-02-"), F.col("p_size").cast("string"))
    rest = F.concat(cell(F.lit("-")), cell(F.col("p_type")), cell(F.lit("-")), cell(F.lit("-")), cell(day))
    row = F.concat(
        F.lit("<tr>"), link, cell(F.concat(F.col("p_name"), F.lit(" &amp; Söhne"))),
        cell(F.concat(F.lit("City<br>"), F.col("p_size").cast("string"))),
        F.when(key % 6 != 5, rest).otherwise(""), F.lit("</tr>"),
    )
    return (
        table(spark, folder, "part")
        .groupBy(F.floor(key / 50).alias("page_no"))
        .agg(F.concat_ws("", F.collect_list(row)).alias("body"))
        .select("page_no", F.concat(F.lit("<html><body><table>"), F.col("body"), F.lit("</table></body></html>")).alias("html"))
    )


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url", "html")


def part_detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Detail pages of postings, in the layouts the selectors know; some lack a section."""
    key = F.col("p_partkey")
    name = F.concat(F.col("p_name"), F.lit(" &lt;"), F.col("p_brand"), F.lit("&gt;"))
    head = F.concat(F.lit("<html><head><title>"), name, F.lit(" - Job Board</title></head><body>"))
    heading = F.concat(F.lit("<h1 class='jobTitle'>"), name, F.lit("</h1>"))
    header_cell = F.concat(F.lit("<h1> </h1><table><tr><td class=detailsHeader>"), name, F.lit("</td></tr></table>"))
    title = _choose(key, 4, {0: heading, 1: header_cell}, F.lit(""))
    contract = F.concat(F.lit("<table><tr><td class='contractType'>"), F.col("p_type"), F.lit("</td></tr></table>"))
    facts = F.concat(
        F.lit("<span class='jobLocation'>City "), F.col("p_size").cast("string"), F.lit("</span>"),
        F.when(key % 5 != 2, contract).otherwise(""),
    )
    text = F.concat(F.lit("<p>Work on "), F.col("p_name"), F.lit("</p><script>var x = 1;</script><p>at "), F.col("p_brand"), F.lit("</p>"))
    body = _choose(
        key,
        6,
        {
            0: F.concat(F.lit("<div class='jobDescription'>"), text, F.lit("</div>")),
            1: F.concat(F.lit("<section id='jobDescription'>"), text, F.lit("</section>")),
            2: F.concat(F.lit("<div class='jobDescription'> </div><div class='a description'>"), text, F.lit("</div>")),
        },
        F.concat(F.lit("<article>"), text, F.lit("</article>")),
    )
    # A few MB of parts are hundreds of MB of pages, which one task would build and hand to the parser.
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return parts.select(
        key.alias("page_id"),
        F.concat(F.lit(f"{BASE_URL}/vacancy/"), key.cast("string")).alias("url"),
        F.concat(head, title, facts, body, F.lit("</body></html>")).alias("html"),
    )


def posting_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as postings; their label names the board."""
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("Board"), F.col("label").cast("string")).alias("source_id"),
        F.col("vec_id").cast("string").alias("job_id"),
        F.col("embedding").alias("vector"),
    )


def user_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as users, who subscribe to their own board and a second one."""
    label, key = F.col("label"), F.col("vec_id")

    def board(number: Column) -> Column:
        return F.concat(F.lit("Board"), number.cast("string"))

    return table(spark, folder, "embeddings").select(
        key.cast("string").alias("user_id"),
        F.array(board(label), board(key % 4)).alias("enabled_sources"),
        F.col("embedding").alias("vector"),
    )


def taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """tag and keyword: the words of part names."""
    words = table(spark, folder, "part").select(F.explode(F.split("p_name", " ")).alias("tag")).distinct()
    return words.select("tag", F.col("tag").alias("keyword"))


def tagged_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users with the words of the part of their number as tags, some with none."""
    key = F.col("c_custkey")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("c_custkey"), "p_name")
    none = F.array().cast("array<string>")
    own = F.when(key % 9 == 4, none).otherwise(F.coalesce(F.array_distinct(F.split("p_name", " ")), none))
    users_ = table(spark, folder, "customer").select("c_custkey").join(parts, "c_custkey", "left")
    return users_.select(key.cast("string").alias("user_id"), own.alias("tags"))
