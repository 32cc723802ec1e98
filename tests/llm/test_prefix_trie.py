import hashlib
import random
import zlib

import duckdb
import numpy as np

from devtide.llm import prefix_trie

from . import corpus

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def truncated(c: int) -> int:
    """c - c % 5 with the remainder that SQL has."""
    return c - (abs(c) % 5) * (1 if c >= 0 else -1)


def sequences(rows: list[tuple]) -> dict[int, list[tuple]]:
    """The rebuilt conversations of rows (conv_id, turn, role, text)."""

    def order(row):
        role, text = row[2] or "", row[3] or ""
        key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        return (row[1] is not None, row[1] or 0, key)

    original: dict[int, list] = {}
    for row in rows:
        if row[0] is not None:
            original.setdefault(row[0], []).append(row)
    plain = {c: [(r[2] or "", r[3] or "") for r in sorted(found, key=order)] for c, found in original.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = plain.get(truncated(c), [])[:h] + own[h:]
    return out


def brute(found: dict[int, list[tuple]]) -> list[tuple]:
    """A plain trie, node by node."""
    numbers: dict[tuple, int] = {}
    nodes = [{"up": None, "depth": 0, "size": 0, "members": [], "ends": []}] if found else []
    for c in sorted(found):
        at = 0
        nodes[0]["members"].append(c)
        for turn in found[c]:
            if (at, turn) not in numbers:
                numbers[at, turn] = len(nodes)
                nodes.append(
                    {"up": at, "depth": nodes[at]["depth"] + 1, "size": len(turn[1].encode()), "members": [], "ends": []}
                )
            at = numbers[at, turn]
            nodes[at]["members"].append(c)
        nodes[at]["ends"].append(c)
    for node in nodes:
        node |= {"children": 0, "leaves": 0, "saved": (len(node["members"]) - 1) * node["size"]}
    for node in reversed(nodes):
        node["leaves"] += not node["children"]
        if node["up"] is not None:
            up = nodes[node["up"]]
            up["children"] += 1
            up["leaves"] += node["leaves"]
            up["saved"] += node["saved"]
    return sorted(
        (
            (
                n["members"][0],
                n["depth"],
                None if n["up"] is None else nodes[n["up"]]["members"][0],
                len(n["members"]),
                n["children"],
                n["leaves"],
                n["saved"],
                hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest(),
            )
            for n in nodes
        ),
        key=repr,
    )


def saved(spark, folder, rows: list[tuple], clashing: bool = False) -> str:
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        for name in ("place", "name", "size", "depth", "a", "items"):
            df = df.selectExpr("*", f"'{name}' as {name}")
    return corpus.save(df.repartition(3), folder, "conversations")


def checked(spark, folder, rows: list[tuple], sql: bool = True, clashing: bool = False) -> None:
    path = saved(spark, folder, rows, clashing)
    got = prefix_trie.op11_prefix_trie(spark, path)
    assert got.columns == COLUMNS
    assert [k for _, k in got.dtypes] == ["bigint"] * 7 + ["string"]
    want = brute(sequences(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == want
    if sql:
        with duckdb.connect() as con:
            con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
            assert sorted(con.sql(prefix_trie.ORACLE).select(*COLUMNS).fetchall(), key=repr) == want


def test_random_conversations(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (c, k, rng.choice(["u", "b"]), rng.choice(["x", "yy", "é"]))
        for c in [*range(-12, 60), *range(1000, 1040, 3)]
        for k in range(rng.randint(1, 12))
    ]
    rng.shuffle(rows)
    checked(spark, tmp_path, rows)


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [(None, 1, "u", "x"), (None, None, None, None), (5, None, None, None), (5, None, "u", "long"), (5, 1, "u", "a")]
    rows += [(6, 1, "u", "a")] * 3 + [(6, 1, "b", "a"), (6, 1, "ba", ""), (7, 2, "u", "q" * 50_000), (8, 0, "u", "")]
    rows += [(c, k, "u", "a") for c in range(10, 15) for k in range(3)]
    checked(spark, tmp_path, rows, clashing=True)


def test_long_conversations_of_several_levels(spark, tmp_path):
    """Lengths around the width of a row and of a row of rows, with shared beginnings."""
    rng = random.Random(8)
    width = prefix_trie.WIDTH
    long = [("u", rng.choice("ab")) for _ in range(width * width + 130)]
    rows = []
    for c, n in enumerate([width - 1, width, width + 1, 2 * width, 5 * width + 3, width * width, len(long), len(long), 20]):
        own = list(long[:n])
        if c in (4, 7):
            own[-7] = ("u", "other")
        rows += [(5 * c + 3, k, *turn) for k, turn in enumerate(own)]
    checked(spark, tmp_path, rows, sql=False)


def test_one_beginning_for_most(spark, tmp_path):
    """A first turn, a whole conversation and a parent that hold most rows."""
    rows = [(c, k, "u", f"t{k}" if c % 3 else f"t{k * (c % 7)}") for c in range(0, 700) for k in range(4 + c % 2)]
    checked(spark, tmp_path, rows)


def test_ends_of_one_node_come_in_packs(spark):
    ends = spark.range(40_000).selectExpr("7L as a", "9L as b", "id * 3 as conv_id").repartition(7)
    got = prefix_trie._digests(ends.union(spark.createDataFrame([(1, 2, 5)], "a long, b long, conv_id long"))).collect()
    whole = hashlib.sha256(",".join(str(3 * k) for k in range(40_000)).encode()).hexdigest()
    assert {(r.a, r.digest) for r in got} == {(7, whole), (1, hashlib.sha256(b"5").hexdigest())}


def test_names_differ_by_side_and_order():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 2**63, (2, 1000, 2)).astype(np.uint64)
    found = np.concatenate([prefix_trie._joined(x, y), prefix_trie._joined(y, x), prefix_trie._joined(x, x)])
    assert len(np.unique(found, axis=0)) == 3000
    assert len(np.unique(found[:, 0])) == len(np.unique(found[:, 1])) == 3000


def test_turnless_only_and_empty(spark, tmp_path):
    # The only turn of a conversation whose head is taken from a base that is not there.
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    checked(spark, tmp_path / "one", [(c, 0, "u", "x")])
    checked(spark, tmp_path / "none", [])
