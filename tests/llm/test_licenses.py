import random
import re

from devtide.llm import licenses

from . import corpus


def words(value):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", corpus.lowered(value))


def brute(value):
    own = words(value)
    places = [
        (i, label)
        for label, phrase in licenses.PHRASES
        for i in range(len(own))
        if own[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(own),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


MIT = next(text for label, family, text in licenses.TEMPLATES if label == "mit")
GPL = [text for label, family, text in licenses.TEMPLATES if family == "gpl"]


def rows():
    rng = random.Random(4)
    parts = ["under the MIT", "license", "Under THE mit License.", "apache license, version 2.0", "CC BY-NC", "cc by", "nc", "é", "x\n"]
    made = [(100 + k, " ".join(rng.choices(parts, k=rng.randint(0, 30))), "aa", "s", 0) for k in range(60)]
    changed = MIT.split()
    changed[5:6] = ["some", "other"]
    del changed[20]
    return made + corpus.edge_rows() + [
        (200, f"before {MIT} after", "aa", "s", 0),
        (201, " ".join(changed), "aa", "s", 0),
        (202, " ".join(MIT.split()[:12]), "aa", "s", 0),
        (203, f"{GPL[1]} and {GPL[0]}", "aa", "s", 0),
        (204, GPL[1], "aa", "s", 0),
        (205, "cc by nc " * 4000, "aa", "s", 0),
    ]


def test_contract_and_labels(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, rows(), clashing=True), tmp_path)
    query = licenses.op7_license_scan(spark, folder)
    assert query.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = query.collect()
    base = [(r["doc_id"], *[r[c] for c in query.columns[1:6]]) for r in got]
    assert sorted(base, key=repr) == sorted(((r[0], *brute(r[1])) for r in rows()), key=repr)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[200]["labels"] == "mit" and by_id[200]["score"] == 1.0
    assert by_id[201]["labels"] == "mit" and 0.75 <= by_id[201]["score"] < 1.0
    assert by_id[202]["labels"] == "" and by_id[202]["score"] == 0.0
    assert by_id[203]["labels"] == "gpl-2,gpl-3"
    assert by_id[204]["labels"] == "gpl-3"
    for row in got:
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))


def test_main_path_is_native(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, rows()), tmp_path)
    texts, places, spans = licenses.scan(spark.read.parquet(f"{folder}/documents.parquet"))
    for df in (texts, places, spans, licenses.op7_license_scan(spark, folder)):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|MapInArrow", plan)


def test_empty_table(spark, tmp_path):
    folder = corpus.save(corpus.documents(spark, []), tmp_path)
    assert licenses.op7_license_scan(spark, folder).collect() == []


def test_many_overlapping_spans_meet_in_blocks(spark):
    """The fuller of two overlapping spans stays, wherever they lie, compared with all pairs."""
    rng, rows = random.Random(6), []
    for doc in (1, None):
        for k in range(400):
            start = rng.randint(0, 4000)
            end = start + rng.choice([5, 30, 300, 700])
            rows.append((doc, 5, f"t{k % 3}", "x", f"f{k % 2}", k, start, end, rng.randint(75, 100) / 100))
    schema = "doc_id long, mark long, template string, label string, family string, span long, start int, end int, share double"
    got = licenses.fullest(spark.createDataFrame(rows, schema))
    want = [
        (x[0], x[1], x[3], x[4], *x[6:])
        for x in rows
        if not any(y[0] == x[0] and y[4] == x[4] and y[6] < x[7] and x[6] < y[7] and y[8] > x[8] for y in rows)
    ]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
