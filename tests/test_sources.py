import json

import pytest
from pyspark.sql import functions as F

from fixtures import keys, postings, registry
from jobweave import standins
from jobweave.operators import duplicates, repair, tags
from jobweave.sources import html, ingest, payload
from jobweave.sources.registry import board_configs, open_sources, read_registry, read_registry_yaml, source_labels, with_defaults

BASE = "https://jobs.example.org"


def test_registry_defaults_and_open_boards(spark, tmp_path):
    row = with_defaults(registry(spark)).filter("source_id = 'second'").first()
    assert (row.display_name, row.enabled, row.color, row.enabled_by_default) == ("second", False, "#555555", False)
    assert keys(open_sources(registry(spark)), "source_id", "preselected") == {("board", True)}
    assert keys(source_labels(registry(spark)), "label", "short_name") == {("BoJ", "Board of Jobs"), ("SECOND", "second"), ("Third", "Third Board")}
    configs = board_configs(registry(spark))
    assert {k: c["enabled"] for k, c in configs.items()} == {"board": True, "second": False, "third": False}
    path = tmp_path / "sources.json"
    path.write_text(json.dumps([{"source_id": "x", "enabled": True}]))
    assert keys(read_registry(spark, str(path)), "source_id", "display_name", "enabled") == {("x", "x", True)}
    pytest.importorskip("yaml")
    path = tmp_path / "sources.yaml"
    path.write_text("sources:\n  x:\n    enabled: true\n    search_keywords: [data]\n  y: {}\n")
    assert keys(read_registry_yaml(spark, str(path)), "source_id", "enabled", "color") == {("x", True, "#555555"), ("y", False, "#555555")}


def test_payload_rows(spark):
    def col(name, value, **more):
        return {"name": name, "value": value, **more}

    rows = [
        [col("title", "old"), col("job_posting_ref", "J1", html='<a href=\\"\\/v\\u003fid\\u003d1\\">'), col("title", "new")],
        [col("job_posting_ref", "J2", html='<a class="x" href="http://other.example/2">')],
        [col("job_posting_ref", "J3"), col("title", None), col("end_date", "2025-01-01")],
        [col("job_posting_ref", "")],
        [col("title", "no reference")],
    ]
    pages = [(json.dumps({"rows": [{"columns": r} for r in rows]}),), ("not json",), (None,), ("{}",)]
    stubs = payload.payload_stubs(spark.createDataFrame(pages, "payload string"), BASE)
    assert keys(stubs, "job_id", "title", "deadline", "url") == {
        ("J1", "new", "", BASE + "/v\\u003fid=1"),
        ("J2", "", "", "http://other.example/2"),
        ("J3", "", "2025-01-01", ""),
    }


def test_listing_rows(spark):
    cells = "".join(f"<td>c{i}</td>" for i in range(3, 9))
    page = f"""<table><tr><th>x</th></tr>
      <tr><td><a class="archiveLink" href="/a?x=1&amp;y=2"> J1 </a></td><td> A &amp;
         B</td><td>Paris</td>{cells}</tr>
      <tr><td><a class='other archiveLink' href='http://h.example/2'>J2</a></td><td>Short</td></tr>
      <tr><td><a class="archiveLink" href="/3">  </a></td><td>no id</td></tr>
      <tr><td><a href="/4">J4</a></td></tr></table>"""
    stubs = html.listing_stubs(spark.createDataFrame([(page,), (None,), ("",)], "html string"), BASE)
    assert keys(stubs, "job_id", "title", "location", "contract_type", "deadline", "url") == {
        ("J1", "A & B", "Paris", "c4", "c7", BASE + "/a?x=1&y=2"),
        ("J2", "Short", "", "", "", "http://h.example/2"),
    }


def test_detail_selectors_in_order(spark):
    pages = {
        1: "<title>T - Site</title><body><h1> </h1><div class='jobDescription'> </div><td class='detailsRight'>right</td><p>other",
        2: "<body><h1>Head<br>line</h1><div class='a description b'><p>one</p><p>two &lt;3</p></div><script>no()</script>",
        3: "<body>" + "x" * 9000 + "</body>",
    }
    df = spark.createDataFrame(list(pages.items()), "page int, html string")
    found = {r.page: r for r in html.page_details(df, title_suffix=" - Site").collect()}
    assert (found[1].title, found[1].description_raw) == ("T", "right")
    assert (found[2].title, found[2].description_raw) == ("Head\nline", "one\ntwo <3")
    assert found[3].description_raw == "x" * 9000 and found[3].title == ""
    assert html.page_details(df.filter("page = 3"), body_chars=8000).first().description_raw == "x" * 8000


def test_boards_fail_alone(spark):
    raw = spark.createDataFrame([(1, "A", None), (2, None, "2025-01-01")], "job_id int, title string, scraped_at string")

    def broken(spark_, config):
        return spark_.read.parquet("/nowhere/at/all")

    def planned(spark_, config):
        raise NotImplementedError

    configs = {"good": {"enabled": True}, "bad": {"enabled": True}, "later": {"enabled": True}, "off": {}}
    loaders = {"good": lambda s, c: raw, "bad": broken, "later": planned, "off": broken}
    records, status = ingest.ingest_sources(spark, configs, loaders, F.lit("now"))
    assert keys(records, "source_id", "job_id", "title", "url", "scraped_at") == {("good", "1", "A", "", "now"), ("good", "2", "", "", "2025-01-01")}
    assert keys(status, "source_id", "status") == {("good", "loaded"), ("bad", "failed"), ("later", "placeholder"), ("off", "disabled")}


def test_extras_override_or_yield(spark):
    extra = F.create_map(F.lit("title"), F.lit("own"), F.lit("grade"), F.lit("P4"))
    jobs = postings(spark).withColumn("extra", extra)
    wins = ingest.merge_extras(jobs).select(F.col("record")["title"], F.col("record")["grade"]).first()
    loses = ingest.merge_extras(jobs, extra_wins=False).select(F.col("record")["title"], F.col("record")["grade"]).first()
    assert tuple(wins) == ("own", "P4") and tuple(loses) == ("Clock Repairer", "P4")


def test_silent_boards_are_reported(spark):
    health = ingest.source_health(with_defaults(registry(spark)), postings(spark).limit(0))
    assert keys(health, "source_id", "n_records", "is_silent") == {("board", 0, True)}


def test_backfill_refuses_closed_titles(spark):
    stored = [
        ("J1", "b", "", "", "", None, "text", "u1", ""), ("J2", "b", None, "Rome", "", "", "", "u2", ""), ("J3", "b", " ", "", "", "", "", "", ""),
        ("J4", "b", "kept", "", "", "", "", "", ""), ("J5", "b", "", "", "", "", "", "u5", ""), ("J6", "b", "", "", "", "", "", "", ""),
    ]
    stubs = [("J1", "b", " New ", "Oslo", " ", "", "", "", ""), ("J2", "b", "J2\nClosed Job", "Bari", "Staff", "", "", "", "")]

    def pages(spark_):
        rows = [("u1", "x", "x", "x", "x", "ignored"), ("u2", "x", "x", "x", "x", "found"), ("u5", "TRK5", "Bonn", "", "", "five "), ("", "x", "x", "x", "x", "x")]
        return spark_.createDataFrame(rows, "url string, title string, location string, contract_type string, deadline string, description_raw string")

    untitled = repair.untitled_postings(postings(spark, stored), F.lit("b"))
    assert keys(untitled, "job_id") == {("J1",), ("J2",), ("J5",), ("J6",)}
    matched = repair.match_listing(untitled, postings(spark, stubs), [F.col("title")])
    patched = repair.patch(repair.with_details(matched, pages(spark)), "TRK")
    assert keys(repair.field_changes(patched), "job_id", "field", "old", "new") == {
        ("J1", "title", "", "New"), ("J1", "location", "", "Oslo"), ("J2", "contract_type", "", "Staff"),
        ("J5", "location", "", "Bonn"),
    }
    assert tuple(repair.patch_tally(patched).first()) == (4, 2, 3)
    after = repair.apply_patch(postings(spark, stored), patched)
    assert keys(after, "job_id", "title", "description_raw") == {("J1", "New", "text"), ("J2", None, "found"), ("J3", " ", ""), ("J4", "kept", ""), ("J5", "", "five "), ("J6", "", "")}


def test_taxonomy_tags(spark):
    words = tags.taxonomy_table(spark)
    assert words.count() == 24
    jobs = postings(spark, [("1", "b", "Clock Repairer", "", "", "", "Leads a DevOps team, once Data  Engineer", "", ""), ("2", "b", None, "", "", "", "", "", "")])
    found = tags.tag_new_postings(jobs, jobs.filter("false"), words)
    assert {r.job_id: r.tags for r in found.collect()} == {"1": ["data-engineer", "devops"], "2": []}
    assert tags.tag_new_postings(jobs, found, words).isEmpty()
    assert keys(tags.with_tag(found, "devops"), "job_id") == {("1",)}


def test_a_taxonomy_of_any_size(spark):
    many = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("tag"), F.concat(F.lit("key word"), "id").alias("keyword"))
    jobs = postings(spark, [("1", "b", "KEY word77", "", "", "", "a key word4999, key word77", "", ""), ("2", "b", "key", "", "", "", "words5", "", "")])
    found = tags.tag_new_postings(jobs, jobs.filter("false"), many)
    assert {r.job_id: r.tags for r in found.collect()} == {"1": ["t4999", "t77"], "2": []}
    assert {r.tags[0] if r.tags else None for r in tags.tag_new_postings(jobs, jobs.filter("false"), many.limit(0)).collect()} == {None}


def test_a_board_may_fail_in_any_way(spark, tmp_path):
    good = spark.createDataFrame([("1", "x")], "job_id string, title string")
    broken = tmp_path / "broken"
    good.coalesce(1).write.parquet(str(broken))
    for file in broken.glob("part-*"):
        file.write_bytes(b"PAR1 this is no parquet file PAR1")

    def unreachable(s, config):
        raise RuntimeError("no route")

    def silent(s, config):
        raise OSError

    loaders = {
        "good": lambda s, c: good, "raises": unreachable, "silent": silent,
        "garbled": lambda s, c: s.read.schema(good.schema).parquet(str(broken)),
        "late": lambda s, c: good.withColumn("title", F.raise_error(F.lit("while reading"))),
    }
    records, status = ingest.ingest_sources(spark, {k: {"enabled": True} for k in loaders}, loaders, F.lit("now"))
    assert keys(status, "source_id", "status") == {("good", "loaded"), *((k, "failed") for k in ("raises", "silent", "garbled", "late"))}
    assert all(r.error for r in status.filter("status = 'failed'").collect())
    assert keys(records, "source_id", "job_id") == {("good", "1")}

def test_tag_scores(spark):
    pairs = spark.createDataFrame([(["a", "b"], ["a", "c", "b"]), (["x"], ["a"]), (["a"], [])], "job_tags array<string>, user_tags array<string>")
    scored = pairs.select(*[c.alias(n) for n, c in tags.overlap(F.col("job_tags"), F.col("user_tags")).items()]).collect()
    assert [tuple(r) for r in scored] == [(2, 3, 7), (0, 1, 1), (0, 0, None)]


def test_copies_on_one_board_are_no_cross_post(spark):
    texts = [("1", "a", "Same  text"), ("2", "b", "same text "), ("3", "b", "SAME\ttext"), ("4", "a", "own"), ("5", "a", "own")]
    jobs = spark.createDataFrame(texts, "job_id string, source_id string, text string")
    found = duplicates.cross_source_groups(jobs, F.col("text"))
    assert keys(found, "source_id", "job_id", "n_copies", "n_boards") == {("a", "1", 3, 2)}


def test_pages_of_a_small_file_are_spread(spark, tmp_path):
    """One file of parts is one task's input; its pages are parsed by many."""
    parts = spark.range(50, numPartitions=1).selectExpr(
        "id AS p_partkey", "concat('part ', id) AS p_name", "'Brand#1' AS p_brand", "'STEEL' AS p_type", "cast(id % 7 AS int) AS p_size"
    )
    parts.write.parquet(f"{tmp_path}/part.parquet")
    found = html.page_details(standins.part_detail_pages(spark, str(tmp_path)))
    assert found.count() == 50
    assert found.select(F.spark_partition_id()).distinct().count() > 1
