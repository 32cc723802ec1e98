"""N-gram Jaccard join with token-combination prefixes.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Equal sets are one
*node* from the start. Shingles have one global order: rare ones first, then frequent ones,
each by hash; a shingle is frequent if a count sketch of fixed size over all documents says
so. A node's prefix is extended until the shingles in it that another node may lack cannot
cover it: a rare shingle counts one, and in a group of frequent ones each beyond the first
counts one. Two nodes that are similar enough then share a single rare shingle of both
prefixes or a pair of frequent ones of one group, so these are the signatures that are
indexed. The groups depend on the size of the set; sizes of similar nodes are at most one
size class apart, so each node uses the groups of its own class and of the one below.

Nodes with a common signature stand in a *run*. Runs of up to ``SMALL`` nodes give their
pairs, larger ones pairs with a hub (a smallest member). An exact bound drops most that do
not link: parity bitmaps never differ in more bits than the sets do in shingles. First each
node is verified against the partner with which it shares most signatures. Larger runs whose
members are then all connected need nothing more, so a large group of near copies costs one
check a member. In the others each member is verified against the nearest one of another
component, a few times over, and then every pair that is still across components is tested, by the same bound
inside the run and by the sets themselves for the pairs that pass. No link is lost; pairs within
a component are never formed there.

Defined results: a text that is null or has no word has an empty set (0 shingles) and its own
id as component; fewer than five words are one shingle; repeated rows are copies of each
other; ids may repeat, and a row without an id takes part but never names a component unless
it is alone (then the component is null). Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import components

SHINGLE = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Counters in each of the two rows of the sketch; its size does not depend on the data.
SKETCH = 1 << 18
#: A shingle is frequent if both counters exceed the mean by this, or by 8 standard deviations.
FREQUENT = 64
#: Bits of the filter that keeps sets of nodes without a partner from being moved.
FILTER_BITS = 1 << 23
#: Cells of a parity bitmap for each shingle, at least. Bitmaps are moved once for each row of a
#: larger run, so their length is most of what the join shuffles.
CELLS = 2
#: Bits of the filter of ids for each id, and at most (8 MB go to every task).
ID_BITS, MOST_ID_BITS = 16, 1 << 26
#: Members that are verified against one copy of their hub's set.
SHARE = 512
#: Runs up to this size give all their pairs at once.
SMALL = 16
#: Rounds in which members of larger runs meet only the nearest one of another component. They
#: save pairs; the last round takes all that are left, however many those are.
NEAREST_ROUNDS = 2
#: Members of a run that one member is compared with at once.
BLOCK = 4096

_M = shared.MULTIPLIERS
_BITS = SKETCH.bit_length() - 1
_OUT_ROWS = 200_000
#: Pairs that a task remembers so as not to give them again.
_SEEN = 1_000_000


# -- sets -----------------------------------------------------------------------------------


def sets_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingle hashes of all texts, in order."""
    for first, _, data, offsets in shared.chunks(texts):
        words, begin, _, _ = shared.word_hashes(data, offsets)
        grams = np.zeros(0, np.uint64)
        if len(words) >= SHINGLE:
            last = len(words) - SHINGLE + 1
            grams = words[:last] * _M[0]
            for k in range(1, SHINGLE):
                grams += words[k : last + k] * _M[k]
            grams = shared.mix(grams)
        for i in range(len(offsets) - 1):
            a, b = begin[i], begin[i + 1]
            if b - a >= SHINGLE:
                yield first + i, np.unique(grams[a : b - SHINGLE + 1])
            elif b > a:
                whole = (words[a:b] * _M[: b - a]).sum(keepdims=True) + _M[16 + b - a]
                yield first + i, shared.mix(whole)
            else:
                yield first + i, np.zeros(0, np.uint64)


def node_of(tokens: np.ndarray) -> int:
    """Hash of a set that is not empty, as a signed 64-bit number."""
    size = np.array([len(tokens)], np.uint64) * _M[21]
    return int(shared.mix(shared.mix(tokens ^ _M[20]).sum(keepdims=True) + size).view(np.int64)[0])


def _parity(tokens: np.ndarray) -> bytes:
    """One bit per cell: whether an odd number of shingles falls into it. ``CELLS`` for each
    shingle, rounded up to a power of two, 64 at least."""
    size = max(64, 1 << int(CELLS * len(tokens) - 1).bit_length())
    cells = (tokens >> np.uint64(32)).astype(np.int64) & (size - 1)
    odd = (np.bincount(cells, minlength=size) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node, size and bitmap of each document (the bitmap once a node and task); at the end,
    the task's part of the sketch, in a row without a size."""
    names = ["doc_id", "node", "n", "bits"]
    sketch = np.zeros(2 * SKETCH, np.int64)
    seen: set[int] = set()
    for batch in batches:
        nodes: list[int | None] = []
        sizes: list[int] = []
        bits: list[bytes | None] = []
        kept: list[np.ndarray] = []
        waiting = 0
        for _, tokens in sets_of(shared.texts_of(batch)):
            node = node_of(tokens) if len(tokens) else None
            new = node is not None and node not in seen
            sizes.append(len(tokens))
            nodes.append(node)
            bits.append(_parity(tokens) if new else None)
            if new:
                seen.add(node)
            kept.append(tokens)
            waiting += len(tokens)
            if waiting > SKETCH:
                sketch += _counted(np.concatenate(kept))
                kept, waiting = [], 0
        if waiting:
            sketch += _counted(np.concatenate(kept))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(nodes, pa.int64()),
                pa.array(sizes, pa.int32()),
                pa.array(bits, pa.binary()),
            ],
            names,
        )
    part = zlib.compress(sketch.tobytes(), 1)
    yield pa.RecordBatch.from_arrays(
        [
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, pa.int32()),
            pa.array([part], pa.binary()),
        ],
        names,
    )


def _cells(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    high = (tokens >> np.uint64(64 - _BITS)).astype(np.int64)
    return high, (tokens & np.uint64(SKETCH - 1)).astype(np.int64)


def _counted(tokens: np.ndarray) -> np.ndarray:
    high, low = _cells(tokens)
    return np.concatenate(
        [np.bincount(high, minlength=SKETCH), np.bincount(low, minlength=SKETCH)]
    )


def frequent_cells(sketches: DataFrame) -> np.ndarray:
    """Two rows of flags, from the sum of all sketches (a tree of sums of fixed size)."""
    total = shared.tree_fold(sketches, "bits", np.zeros(2 * SKETCH, np.int64), np.add, packed=True)
    mean = total[:SKETCH].sum() / SKETCH
    return (total > mean + max(FREQUENT, 8 * mean**0.5)).reshape(2, SKETCH)


# -- signatures -----------------------------------------------------------------------------


def _missing(n: int) -> int:
    """Shingles of a set of n that a similar set may lack, and one more."""
    return n - -(-PERCENT * n // 100) + 1


def _groups(level: int) -> int:
    return max(1, int(0.16 * 1.25**level))


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Signatures of a set: single rare shingles, pairs of frequent ones."""
    n = len(tokens)
    need = _missing(n)
    high, low = _cells(tokens)
    often = frequent[0, high] & frequent[1, low]
    rare = tokens[~often]
    if len(rare) >= need or n < 2:
        return rare[:need] if n > 1 else np.zeros(0, np.uint64)
    rest, out = tokens[often], [rare]
    top = int(np.log(n) / np.log(1.25))
    for level in {top, max(top - 1, 0)}:
        group = ((rest >> np.uint64(24)) % np.uint64(_groups(level))).astype(np.int64)
        again = np.ones(len(rest), bool)
        again[np.unique(group, return_index=True)[1]] = False
        end = int(np.searchsorted(np.cumsum(again), need - len(rare))) + 1
        order = np.argsort(group[:end], kind="stable")
        group, members = group[:end][order], rest[:end][order]
        for step in range(1, end):
            same = group[step:] == group[:-step]
            if not same.any():
                break
            pair = members[:-step][same] * _M[30] + members[step:][same] * _M[31]
            out.append(shared.mix(pair + np.array([level + 1], np.uint64) * _M[32]))
    return np.concatenate(out)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def index_rows(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Signature, node and size for each node; a task gives each node once."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(frequent))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(flags.value).astype(bool).reshape(2, SKETCH)
        seen: set[int] = set()
        sigs, nodes, sizes, rows = [], [], [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    _signed(np.concatenate(sigs)),
                    pa.array(np.repeat(nodes, [len(s) for s in sigs]), pa.int64()),
                    pa.array(np.repeat(sizes, [len(s) for s in sigs]), pa.int32()),
                ],
                ["sig", "node", "n"],
            )

        for batch in batches:
            for _, tokens in sets_of(shared.texts_of(batch)):
                if len(tokens) < 2 or (node := node_of(tokens)) in seen:
                    continue
                seen.add(node)
                sigs.append(signatures(tokens, table))
                nodes.append(node)
                sizes.append(len(tokens))
                rows += len(sigs[-1])
                if rows > _OUT_ROWS:
                    yield flush()
                    sigs, nodes, sizes, rows = [], [], [], 0
        if rows:
            yield flush()

    return shared.arrow_map(docs.select("text"), work, "sig long, node long, n int")


# -- runs -----------------------------------------------------------------------------------


def _whole_runs(
    batches: Iterator[pa.RecordBatch], columns: list[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows again, cut only between runs of equal ``sig``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column(0).to_numpy()
        cut = int(np.searchsorted(sig, sig[-1]))
        if cut == 0 and held and held[-1].column(0)[-1].as_py() == sig[0]:
            held.append(batch)
            continue
        whole = pa.Table.from_batches([*held, batch.slice(0, cut)]) if held or cut else None
        held = [batch.slice(cut)]
        if whole is not None and whole.num_rows:
            yield {c: whole[c].to_numpy() if c != "bits" else whole[c] for c in columns}
    if held:
        whole = pa.Table.from_batches(held)
        yield {c: whole[c].to_numpy() if c != "bits" else whole[c] for c in columns}


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of two nodes or more. Of a small run all pairs of fitting sizes, without ``sig``;
    of a larger one its rows, each with its hub. Members too large for a hub get the next
    one; a hub's own row names the hub before it."""
    for rows in _whole_runs(batches, ["sig", "node", "n"]):
        sig, node, n = rows["sig"], rows["node"], rows["n"].astype(np.int64)
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node, n = sig[new], node[new], n[new]
        start = np.ones(len(sig), bool)
        start[1:] = sig[1:] != sig[:-1]
        run = np.cumsum(start) - 1
        size = np.bincount(run)[run] if len(run) else run
        small = (size > 1) & (size <= SMALL)
        yield _run_batch(None, *_small_pairs(run[small], node[small], n[small]))
        large = size > SMALL
        if large.any():
            sig, node, n, start = sig[large], node[large], n[large], start[large]
            shown = _hubs(start, n)
            yield _run_batch(sig, node, n, node[shown], n[shown])


def _run_batch(sig, node, n, hub, hub_n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(len(node), pa.int64()) if sig is None else pa.array(sig),
            pa.array(node),
            pa.array(n.astype(np.int32)),
            pa.array(hub),
            pa.array(hub_n.astype(np.int32)),
        ],
        ["sig", "node", "n", "hub", "hub_n"],
    )


def _small_pairs(run: np.ndarray, node: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    out = [(node[:0], n[:0], node[:0], n[:0])]
    for step in range(1, SMALL):
        fits = (run[step:] == run[:-step]) & (100 * n[:-step] >= PERCENT * n[step:])
        out.append((node[step:][fits], n[step:][fits], node[:-step][fits], n[:-step][fits]))
    return [np.concatenate(column) for column in zip(*out, strict=True)]


def _hubs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each row, the row of its hub; for a hub that of the hub before it in the run."""
    at = np.arange(len(n))
    first = np.maximum.accumulate(np.where(start, at, 0))
    hub = first
    while (far := 100 * n[hub] < PERCENT * n).any():
        # In each run, the first member that is too large is the next hub.
        head = np.where(far, at, len(n))
        head = np.minimum.reduceat(head, np.flatnonzero(start))[np.cumsum(start) - 1]
        hub = np.where(far & (at >= head), head, hub)
    before = np.maximum(hub[at - 1], first)
    return np.where(hub == at, np.where(first == at, at, before), hub)


def runs_of(index: DataFrame) -> DataFrame:
    ordered = index.repartition("sig").sortWithinPartitions("sig", "n", "node")
    return shared.arrow_map(ordered, _run_rows, "sig long, node long, n int, hub long, hub_n int")


# -- verification ---------------------------------------------------------------------------


def _pack(tokens: np.ndarray) -> bytes:
    """The upper 40 bits of each hash, still in order: enough to compare two sets."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 3:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def _filter_of(values: DataFrame, size: int) -> np.ndarray:
    """Packed bits, ``size`` of them (a power of two), of which those at the lower bits of the
    values (one column of hashes, long) are set."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[batch.column(0).to_numpy().view(np.uint64) & np.uint64(size - 1)] = True
        yield pa.RecordBatch.from_pydict({"part": [zlib.compress(np.packbits(bits).tobytes(), 1)]})

    parts = shared.stored(shared.arrow_map(values, fill, "part binary"), "filter")
    return shared.tree_fold(parts, "part", np.zeros(size // 8, np.uint8), np.bitwise_or, packed=True)


def candidate_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``n``, ``tokens`` of the given nodes, perhaps more than once."""
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_of(nodes, FILTER_BITS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(wanted.value)
        seen: set[int] = set()
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for _, tokens in sets_of(shared.texts_of(batch)):
                if len(tokens) < 2 or (node := node_of(tokens)) in seen:
                    continue
                if bits[node % FILTER_BITS]:
                    seen.add(node)
                    out.append((node, len(tokens), _pack(tokens)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int64()),
                    pa.array([r[1] for r in out], pa.int32()),
                    pa.array([r[2] for r in out], pa.binary()),
                ],
                ["node", "n", "tokens"],
            )

    return shared.arrow_map(docs.select("text"), work, "node long, n int, tokens binary")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows a, share, b (null first: the hub's own set), tokens, sorted; pairs that link."""
    hub, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        found: list[tuple[int, int]] = []
        a, share, b = (batch.column(k).to_pylist() for k in range(3))
        tokens = batch.column(3)
        for i in range(batch.num_rows):
            if b[i] is None:
                if hub != (a[i], share[i]):
                    hub, own = (a[i], share[i]), _unpack(tokens[i].as_py())
                continue
            other = _unpack(tokens[i].as_py())
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[at] == other).sum())
            if 100 * both >= PERCENT * (len(own) + len(other) - both):
                found.append((a[i], b[i]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
            ["a", "b"],
        )


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link. The members of a hub are dealt out in shares,
    each with its own copy of the hub's set."""
    shares = pairs.groupBy("a").agg((F.count(F.lit(1)) / SHARE).cast("int").alias("last"))
    pairs = pairs.join(shares, "a").withColumn(
        "share", F.pmod(F.xxhash64("b"), F.col("last") + 1).cast("int")
    )
    members = pairs.join(sets.withColumnRenamed("node", "b"), "b").select(
        "a", "share", "b", "tokens"
    )
    hubs = (
        shares.join(sets.withColumnRenamed("node", "a"), "a")
        .select("a", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("share"), "tokens")
        .select("a", "share", F.lit(None).cast("long").alias("b"), "tokens")
    )
    ordered = (
        members.union(hubs)
        .repartition("a", "share")
        .sortWithinPartitions("a", "share", F.col("b").asc_nulls_first())
    )
    return shared.arrow_map(ordered, _linked, "a long, b long")


def _crossing(batches: Iterator[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of a run from two components that pass the bound on sizes and bitmaps; if
    ``nearest``, for each member that has any only the one with the fewest bits in difference, so
    that a run gives no more pairs than it has members, and each of these is in one. A run with
    such a pair gives a row with its ``sig`` too."""
    seen: set[int] = set()
    for rows in _whole_runs(batches, ["sig", "n", "node", "component", "bits"]):
        edges = np.flatnonzero(np.diff(rows["sig"])) + 1
        bounds = [0, *edges.tolist(), len(rows["sig"])]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            node, group = rows["node"][begin:end], rows["component"][begin:end]
            if (group == group[0]).all():
                continue
            near = _apart_but_near(
                rows["n"][begin:end].astype(np.int64), group, rows["bits"][begin:end].to_pylist()
            )
            pairs = _nearest_pairs(near, end - begin) if nearest else _all_pairs(near)
            if not pairs.shape[1]:
                continue
            pairs = node[pairs]
            marks = shared.mix(pairs[0].view(np.uint64) * _M[40] + pairs[1].view(np.uint64))
            new = np.array([m not in seen for m in marks.tolist()])
            seen.update(marks[new].tolist() if len(seen) < _SEEN else [])
            pairs = pairs[:, new].tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*pairs[0], None], pa.int64()),
                    pa.array([*pairs[1], None], pa.int64()),
                    pa.array([*[None] * len(pairs[0]), int(rows["sig"][begin])], pa.int64()),
                ],
                ["a", "b", "sig"],
            )


def _nearest_pairs(near: Iterator[tuple[int, np.ndarray, np.ndarray]], members: int) -> np.ndarray:
    """Each member with the one that it differs from least, looking both ways; every pair once."""
    least = np.full(members, np.iinfo(np.int64).max)
    other = np.full(members, -1)
    for i, others, differ in near:
        differ = differ.astype(np.int64)
        k = int(np.argmin(differ))
        if differ[k] < least[i]:
            least[i], other[i] = differ[k], others[k]
        closer = differ < least[others]
        least[others[closer]], other[others[closer]] = differ[closer], i
    own = np.flatnonzero(other >= 0)
    ends = np.stack([np.minimum(own, other[own]), np.maximum(own, other[own])])
    return np.unique(ends, axis=1)


def _all_pairs(near: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    found = [np.stack([np.full(len(others), i), others]) for i, others, _ in near]
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _apart_but_near(
    n: np.ndarray, group: np.ndarray, bits: list[bytes]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each member of a run (sorted by size) with those after it that are of another group and
    not ruled out, and the bits in which they differ. Sizes that fit have bitmaps of equal width, or the larger one's is twice as
    wide and is folded."""
    width = np.array([len(b) for b in bits])
    last = np.searchsorted(n * PERCENT, 100 * n, "right")
    starts = np.flatnonzero(np.diff(width, prepend=0))
    for k, start in enumerate(starts.tolist()):
        end = int(starts[k + 1]) if k + 1 < len(starts) else len(n)
        own = np.frombuffer(b"".join(bits[start:end]), np.uint64).reshape(end - start, -1)
        parts = [own]
        if k + 1 < len(starts) and width[end] == 2 * width[start]:
            stop = int(starts[k + 2]) if k + 2 < len(starts) else len(n)
            wide = np.frombuffer(b"".join(bits[end:stop]), np.uint64).reshape(stop - end, 2, -1)
            parts.append(wide[:, 0] ^ wide[:, 1])
        table = np.concatenate(parts)
        for i in range(start, end):
            for low in range(i + 1, min(int(last[i]), start + len(table)), BLOCK):
                high = min(low + BLOCK, int(last[i]), start + len(table))
                other = np.flatnonzero(group[low:high] != group[i]) + low
                differ = np.bitwise_count(table[other - start] ^ own[i - start]).sum(axis=1)
                fits = differ.astype(np.int64) * (100 + PERCENT) <= (n[other] + n[i]) * (100 - PERCENT)
                if fits.any():
                    yield i, other[fits], differ[fits]


def _bound(x: np.ndarray, y: np.ndarray, total: int) -> bool:
    """Whether sets with these parity bitmaps and this sum of sizes can link."""
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    differ = int(np.bitwise_count(x ^ y).sum())
    return differ * (100 + PERCENT) <= total * (100 - PERCENT)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bitmaps leave a link possible."""
    for batch in batches:
        n, m, x, y = (batch.column(k).to_pylist() for k in range(3, 7))
        keep = [
            _bound(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8), i + j)
            for i, j, p, q in zip(n, m, x, y, strict=True)
        ]
        yield batch.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))


def _merged(owner: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node`` and ``component`` after more links between components."""
    if owner is None:
        return shared.stored(components(links), "owners")
    up = components(_lifted(links, owner, "a", "b"))
    moved = up.select(F.col("node").alias("component"), F.col("component").alias("higher"))
    whole = owner.select("node", "component").union(
        # Nodes that had no link before are components of their own.
        up.select("node", F.col("node").alias("component"))
        .join(owner.select("node"), "node", "left_anti")
    )
    whole = whole.join(moved, "component", "left")
    return shared.stored(
        whole.select("node", F.coalesce("higher", "component").alias("component")), "owners"
    )


def _lifted(pairs: DataFrame, owner: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of components for pairs of nodes, as ``a`` and ``b``."""
    of_a = owner.select(F.col("node").alias(a), F.col("component").alias("of_a"))
    of_b = owner.select(F.col("node").alias(b), F.col("component").alias("of_b"))
    joined = pairs.join(of_a, a, "left").join(of_b, b, "left")
    return joined.select(F.coalesce("of_a", a).alias("a"), F.coalesce("of_b", b).alias("b")).distinct()


def _apart(pairs: DataFrame, owner: DataFrame) -> DataFrame:
    """The pairs (hub, node) whose ends are in two components."""
    of_hub = owner.select(F.col("node").alias("hub"), F.col("component").alias("of_hub"))
    joined = pairs.join(owner, "node", "left").join(of_hub, "hub", "left")
    differ = F.coalesce("component", "node") != F.coalesce("of_hub", "hub")
    return joined.filter(differ).select("hub", "node")


def owners(docs: DataFrame, found: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``node`` and ``component`` of all nodes that link to another one."""
    runs = shared.stored(runs_of(index_rows(docs, frequent)), "runs")
    bits = (
        found.filter("n > 1 and bits is not null")
        .groupBy("node")
        .agg(F.first("bits").alias("bits"))
    )
    pairs = (
        runs.filter(f"hub <> node and 100 * hub_n >= {PERCENT} * n")
        .groupBy("hub", "node")
        .agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"), F.first("hub_n").alias("m"))
        .join(bits, "node")
        .join(bits.select(F.col("node").alias("hub"), F.col("bits").alias("hub_bits")), "hub")
        .select("hub", "node", "common", "n", "m", "bits", "hub_bits")
    )
    near = shared.stored(
        shared.arrow_map(pairs, _near, "hub long, node long, common long"), "near"
    )
    large = runs.filter("sig is not null")
    steps = shared.stored(large.select("hub", "node").distinct(), "steps")

    def sets_for(nodes: DataFrame) -> DataFrame:
        found = candidate_sets(docs, nodes).groupBy("node").agg(F.first("tokens").alias("tokens"))
        return shared.stored(found, "sets")

    sets = sets_for(near.select("node").union(near.select("hub")).distinct())
    best = near.groupBy("node").agg(F.max(F.struct("common", "hub")).alias("best"))
    tried = shared.stored(
        best.select(F.col("best.hub").alias("a"), F.col("node").alias("b")), "tried"
    )
    owner = _merged(None, shared.stored(verified(tried, sets), "links"))
    # What is left of the small runs, and the larger runs with more than one component: there,
    # some member stands apart from its hub, or a hub from the one before.
    live = _open_runs(large, _apart(steps, owner))
    for number, nearest in enumerate((*[True] * NEAREST_ROUNDS, False)):
        crossed = shared.stored(_between(large, live, owner, bits, nearest), "crossed")
        # Runs in which the bound leaves nothing are done with.
        live = crossed.filter("sig is not null").select("sig").distinct()
        if not number:
            # All later pairs are among the members that have any pair now.
            paired = crossed.filter("sig is null")
            members = paired.select(F.col("a").alias("node")).union(paired.select("b")).distinct()
            members = members.join(sets.select("node"), "node", "left_anti")
            sets = sets.union(sets_for(shared.stored(members, "members")))
        rest = _apart(near, owner).select(F.col("hub").alias("a"), F.col("node").alias("b"))
        rest = rest.union(crossed.filter("b is not null").select("a", "b")).distinct()
        rest = shared.stored(rest.join(tried, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            owner = _merged(owner, shared.stored(verified(rest, sets), "links"))
            tried = tried.union(rest)
    return owner


def _open_runs(large: DataFrame, apart: DataFrame) -> DataFrame:
    """``sig`` of the larger runs with a pair of ``apart``. Of runs with the same members (the
    windows of one passage), which give the same pairs, one stays."""
    open_runs = large.join(apart, ["hub", "node"], "left_semi").select("sig").distinct()
    members = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    return (
        large.join(open_runs, "sig", "left_semi")
        .groupBy("sig")
        .agg(members.alias("members"), F.count(F.lit(1)).alias("size"))
        .groupBy("members", "size")
        .agg(F.min("sig").alias("sig"))
        .select("sig")
    )


def _between(
    large: DataFrame,
    live: DataFrame,
    owner: DataFrame,
    bits: DataFrame,
    nearest: bool,
) -> DataFrame:
    """Pairs across components within the larger runs ``live``, and the runs that have some."""
    rows = (
        large.join(live, "sig", "left_semi")
        .select("sig", "node", "n")
        .join(bits, "node")
        .join(owner, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .select("sig", "n", "node", "component", "bits")
        .repartition("sig")
        .sortWithinPartitions("sig", "n", "node")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _crossing(batches, nearest)

    return shared.arrow_map(rows, work, "a long, b long, sig long")


def join_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``class_id`` (the smallest id with an equal set)
    for each row of ``docs``."""
    found = shared.stored(
        shared.arrow_map(
            docs.select("doc_id", "text"),
            _summaries,
            "doc_id long, node long, n int, bits binary",
        ),
        "sizes",
    )
    frequent = frequent_cells(found.filter("n is null").select("bits"))
    rows = found.filter("n is not null").select("doc_id", "node", "n")
    owner = owners(docs, found, frequent)
    nodes = (
        rows.filter("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("class_id"))
        .join(owner, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    nodes = shared.stored(nodes, "nodes")
    names = nodes.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = nodes.join(names, "component").select("node", "class_id", "component_id")
    filled = rows.filter("node is not null").join(named, "node", "left")
    empty = rows.filter("node is null").select(
        "doc_id", "n", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id")
    )
    return filled.select("doc_id", "n", "component_id", "class_id").union(empty).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "class_id"
    )


def _by_filter(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose id is certainly none of ``ids`` (distinct), and the others: all
    with such an id and a few more. Nothing is shuffled but ``ids``; a filter of bounded size goes
    to the tasks, so beyond that size more rows are among the others."""
    size = min(MOST_ID_BITS, 1 << max(10, (ID_BITS * ids.count()).bit_length()))
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(ids.select(F.xxhash64("doc_id")), size))

    @F.arrow_udf("boolean")
    def flagged(hashes: pa.Array) -> pa.Array:
        at = hashes.to_numpy().view(np.uint64) & np.uint64(size - 1)
        cell = bits.value[(at >> np.uint64(3)).astype(np.int64)]
        return pa.array((cell >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1)

    # The hash of a null is not null; such a row only takes the way of the others.
    marked = flagged(F.xxhash64("doc_id"))
    return docs.filter(~marked), docs.filter(marked)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: the one with the smallest id. Of rows with
    that same id, one stays. Rows without an id and rows with an empty set stay. Only the texts of
    rows that may have to go are shuffled."""
    found = shared.stored(join_classes(docs).select("doc_id", "component_id", "n_shingles"), "one")
    full = found.filter("doc_id is not null and n_shingles > 0")
    gone = full.filter("doc_id <> component_id").select("doc_id").distinct()
    again = full.filter("doc_id = component_id").groupBy("doc_id").count().filter("count > 1")
    again = again.select("doc_id", F.lit(False).alias("gone"))
    doubtful = gone.withColumn("gone", F.lit(True)).union(again)
    doubtful = shared.stored(doubtful.groupBy("doc_id").agg(F.max("gone").alias("gone")), "doubtful")
    clear, others = _by_filter(docs, doubtful)
    gone, again = (doubtful.filter(f"gone = {x}").select("doc_id") for x in ("true", "false"))
    kept = others.join(gone, "doc_id", "left_anti")
    if not again.isEmpty():
        once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(again, "doc_id", "left_anti").union(once)
    return clear.select(docs.columns).union(kept.select(docs.columns))


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Contract query: the join over all documents."""
    return join_classes(shared.read(spark, sf_dir, "documents"))
