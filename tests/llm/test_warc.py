import hashlib
import random

import pytest
import zstandard
from llm_cases import rows_of  # noqa: F401, F811

from strata.llm import warc as W

BIG, HUGE = "b" * 1500, "<p>é</p>" * 200_000
PAGES = [(1, "http://a", BIG), (2, "http://b", BIG), (3, None, BIG), (4, "u\r\nv", "small"),
         (5, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", HUGE), (9, "u", "x" * 999),
         (10, "u", "x" * 999), (11, "u", "x" * 1000), (12, "u", "x" * 1000), (12, "u", "x" * 1000),
         (None, "u", "y" * 2000), (13, "u", "y" * 2000), (14, "u", "z" * 3000)]
SCHEMA = "page_id bigint, url string, html string"


def brute():
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        same = [j for j, _, h in PAGES if h == html and j is not None] if len(data) >= 1000 else []
        to = max(same, default=None)
        revisit = i is not None and to is not None and i < to
        out.append((i, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=lambda r: [(x is not None, str(type(x)), x) for x in r])


@pytest.fixture(scope="module")
def pages(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame(PAGES, SCHEMA).repartition(2) \
        .select("*", *[F.lit("c").alias(c) for c in ("payload", "n", "sha1", "top", "value", "rows")])


def test_archive_round_trip(pages, scratch):
    out = W.archive(pages, scratch)
    assert rows_of(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == brute()


def test_payloads_index_and_seek(spark, pages, scratch):
    path = W.write_bundles(W.plan_records(pages), scratch + "/w", frame_bytes=4000, bundle_bytes=300)
    full = {r["page_id"]: r for r in W.read_bundles(spark, path).collect()}
    assert full[8]["payload"].decode() == HUGE and full[14]["url"] == "u"
    assert full[4]["url"] == "u%0D%0Av" and full[3]["url"] is None
    some = W.read_bundles(spark, path, ids=[14, 6]).collect()
    assert sorted(r["page_id"] for r in some) == [6, 14]
    files = {r["path"]: bytes(r["content"]) for r in W._files(spark, path).collect()}
    index = W.read_index(spark, path).collect()
    assert len(index) == len(PAGES) and len(files) > 1
    for r in index:     # a record is where the map says, in a frame that unpacks alone
        frame = W.read_frame(files[r["bundle"]], r["frame"])
        assert W.parse_record(frame[r["offset"]:r["offset"] + r["length"]])[0] == r["page_id"]
    for body in files.values():     # skippable frames: the file is a plain Zstandard stream too
        plain = zstandard.ZstdDecompressor().stream_reader(body, read_across_frames=True).read()
        assert plain.count(b"WARC/1.1\r\n") == len(W.record_map(body))


def test_empty_table_and_damage(spark, scratch):
    assert W.archive(spark.createDataFrame([], SCHEMA), scratch).count() == 0
    record = W.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, 3)
    assert W.parse_record(record)[6] == b"abc"
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        W.parse_record(record[:-3])
    with pytest.raises(ValueError):
        W.seek_table(b"not a bundle")


def test_a_payload_that_a_third_of_all_pages_share(spark, scratch):
    # broadcasts off, low thresholds: the hot payload's partition is split
    # as long as what shuffle files compress at a time, else its copies weigh nothing
    hot = random.Random(1).randbytes(16_000).hex()
    rows = [(i, f"http://x/{i}", hot if i % 3 == 0 else f"{i} " + "p" * (1200 if i % 2 else 20)) for i in range(900)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        planned = W.plan_records(spark.createDataFrame(rows, SCHEMA).repartition(6))
        got = planned.collect()
        plan = planned._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan, plan
    assert sorted((r["page_id"], r["refers_to"]) for r in got) == [
        (i, 897 if i % 3 == 0 and i < 897 else None) for i in range(900)]
