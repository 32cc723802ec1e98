import hashlib

from pyspark.sql import functions as F

from devtide.llm import warc_audit

PAGES = "page_id long, url string, html string"


def pages(n=2600):
    made = [(k * 3, f"http://h{k % 7}.example/{k}", f"<p>{'é' * (k % 50)}</p>") for k in range(n)]
    return made + [made[5], (7, None, None), (None, "http://x", "e"), (None, None, None), (None, None, None), (8, "", "e" * 200_000)]


def store(spark, rows, folder):
    spark.createDataFrame(rows, PAGES).withColumn("file", F.lit("clash")).write.mode("overwrite").parquet(f"{folder}/pages.parquet")
    return str(folder)


def test_finds_exactly_the_damage(spark, tmp_path):
    folder = store(spark, pages(), tmp_path)
    got = warc_audit.op6_warc_audit(spark, folder).collect()
    want = set()
    for page_id, _, html in set(pages()):
        if page_id is not None and page_id % warc_audit.DAMAGE == warc_audit.LOST:
            want.add((page_id, "missing"))
        if page_id is not None and page_id % warc_audit.DAMAGE == warc_audit.ALTERED and "e" in (html or ""):
            want.add((page_id, "altered"))
    assert {(r["page_id"], r["kind"]) for r in got} == want and len(got) == len(want)


def test_offsets_and_digests(spark):
    rows = spark.createDataFrame(pages(40), PAGES)
    found = warc_audit.layout(warc_audit.digests(rows)).orderBy("file", "place").collect()
    assert len(found) == 40 + 4
    place = {}
    for r in found:
        assert r["offset"] == place.get(r["file"], 0)
        place[r["file"]] = r["offset"] + r["length"]
    record = (
        "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Target-URI: \r\n"
        "Content-Type: text/html\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    ).encode()
    row = next(r for r in found if r["page_id"] == 7)
    assert row["length"] == len(record) and row["digest"] == hashlib.sha256(record).hexdigest()


def replica(spark, rows):
    return spark.createDataFrame(rows, "file long, place long, offset long, length long, digest string")


def test_any_difference_is_found(spark):
    """Against a plain comparison: altered, missing and extra records, whole files too."""
    left = [(f, p, p * 10, 10, f"{f}-{p}") for f in (-40, -1, 0, 1, 17, 300) for p in range(1 + abs(f) % 37)]
    right = [r for r in left if r[0] != 17 and (r[0], r[1]) != (300, 2)]
    right = [(*r[:4], "other") if (r[0], r[1]) in ((0, 0), (-40, 3)) else r for r in right]
    right += [(5, 0, 0, 10, "new"), (300, 900, 9000, 10, "far")]
    a, b = ({r[:2]: r[2:] for r in side} for side in (left, right))
    want = {
        (*k, "missing" if k not in b else "extra" if k not in a else "altered")
        for k in a.keys() | b.keys()
        if a.get(k) != b.get(k)
    }
    got = warc_audit.audit(replica(spark, left), replica(spark, right)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_equal_and_empty_replicas(spark):
    rows = [(0, 0, 0, 5, "x"), (0, 1, 5, 5, "y")]
    assert warc_audit.audit(replica(spark, rows), replica(spark, rows)).collect() == []
    assert warc_audit.audit(replica(spark, []), replica(spark, [])).collect() == []
    got = warc_audit.audit(replica(spark, rows), replica(spark, [])).collect()
    assert {r["kind"] for r in got} == {"missing"} and len(got) == 2


def test_empty_pages(spark, tmp_path):
    assert warc_audit.op6_warc_audit(spark, store(spark, [], tmp_path)).collect() == []
