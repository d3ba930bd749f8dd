"""SimHash fingerprints, and their near neighbours by a binary trie joined with itself."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import (
    Batches,
    map_batches,
    present,
    ship,
    text_bytes,
    to_arrow,
    whole_groups,
    without,
)
from featloom.llm.components import components
from featloom.session import checkpointed

SHINGLE = 3
BITS = 3
"""Most differing bits of linked fingerprints."""
BLOCK = 16
"""Levels of the trie without a difference: 64 bits in BITS + 1 blocks, one of which is equal."""
LIMIT = 1 << 17
"""Fingerprints below a pair of nodes that one task joins; larger pairs are split further."""
STEP = 8
"""Levels by which a large pair of nodes is split."""
FLUSH = 1 << 18
LEAF = 16
"""Pairs of fingerprints below a pair of nodes that are compared one by one."""


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The SimHash of a text: bit by bit the majority of the XXH64 of its shingles, seed 42.

    A-Z count as a-z, words end at ASCII white space, repeated shingles count again, a shorter
    text is one shingle, and a text without words has 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
        spans = zip(starts, ends[words - 1 :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in spans]
    values = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 4096):
        part = values[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE
) -> DataFrame:
    """doc_id, text_hash and fingerprint (a signed number) of every row; null counts as empty."""

    def make(batch: pa.RecordBatch) -> dict:
        marks = np.array([fingerprint(x, words) for x in text_bytes(batch)], np.uint64)
        return {
            "doc_id": batch.column("doc_id"),
            "text_hash": batch.column("text_hash"),
            "fp": marks.view(np.int64),
        }

    columns = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(present(text)).alias("text_hash"),
        present(text).alias("text"),
    )
    return map_batches(columns, make, "doc_id long, text_hash long, fp long")


def near_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id, n_keep.

    component_id is the smallest doc_id that links of at most ``bits`` differing bits reach; it is
    null only if all of them are null. ``n_keep`` counts the component's rows with that doc_id.
    Equal fingerprints are one node. Empty input gives no rows; other columns are not read.
    """
    marks = checkpointed(fingerprints(docs, text, doc_id, words))
    nodes = checkpointed(marks.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(near_links(nodes.select("fp"), bits=bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = checkpointed(rooted)
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = rooted.join(lows, "root").select("fp", "root", "component_id")
    found = marks.join(classes, "fp")
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.count("*").alias("n_keep"))
    )
    many = kept.where("n_keep > 1")
    return found.join(many, "root", "left").select(
        "doc_id", "text_hash", "fp", "root", "component_id", F.coalesce("n_keep", F.lit(1)).alias("n_keep")
    )


def drop_near(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """``docs`` with one row of every near-duplicate group, the one with the smallest doc_id.

    Columns stay as they are; of several rows with that doc_id in a group one is left.
    """
    groups = near_groups(docs, text, doc_id, words, bits)
    verdicts = groups.select(
        "doc_id",
        F.col("text_hash").alias("key"),
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "n_keep",
        F.col("root").alias("grp"),
    )
    return without(docs, checkpointed(verdicts), doc_id, F.xxhash64(present(text)))


def near_links(fps: DataFrame, limit: int = LIMIT, step: int = STEP, bits: int = BITS) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints of at most ``bits`` differing bits, ``BITS`` at most.

    The trie is walked once for each of four rotations of the bits, the first ``BLOCK`` levels
    without a difference: one of four blocks of two near fingerprints is equal. Below, pairs of
    nodes go down together, their differing bits add up, and a pair over the budget ends. Pairs of
    nodes with more than ``limit`` fingerprints are first split by Spark, ``step`` levels at a time; tasks
    then join the pairs in memory, and return a spanning forest of what they find.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"four blocks find links of 0 to {BITS} bits, not {bits}")
    ship(fps.sparkSession)
    turned = None
    for turn in range(64 // BLOCK):
        value = F.col("fp")
        if turn:
            left = turn * BLOCK
            value = F.shiftleft(value, left).bitwiseOR(F.shiftrightunsigned(value, 64 - left))
        one = fps.select(F.lit(turn).alias("turn"), value.alias("v"))
        turned = one if turned is None else turned.unionByName(one)
    top = F.shiftrightunsigned("v", 64 - BLOCK)
    pairs = turned.select(
        "turn", F.lit(BLOCK).alias("depth"), top.alias("pa"), top.alias("pb"), F.lit(0).alias("side"), "v"
    )
    ready = []
    while True:
        sizes = pairs.groupBy("turn", "depth", "pa", "pb").agg(
            F.count("*").alias("n"), (F.min("side") < F.max("side")).alias("both")
        )
        large = sizes.where((F.col("n") > limit) & (F.col("depth") < 64))
        if large.isEmpty():
            ready.append(pairs)
            break
        large = checkpointed(large)
        keys = ["turn", "depth", "pa", "pb"]
        ready.append(pairs.join(large, keys, "left_anti"))
        open_pairs = large.where((F.col("pa") == F.col("pb")) | F.col("both")).select(*keys)
        pairs = checkpointed(split_pairs(pairs.join(open_pairs, keys), step, bits))
    rows = ready[0]
    for more in ready[1:]:
        rows = rows.unionByName(more)
    rows = rows.repartition("turn", "pa", "pb", "depth").sortWithinPartitions("turn", "pa", "pb", "depth", "side")
    schema = "a long, b long"
    arrow = to_arrow(fps.sparkSession, schema)

    def run(batches: Batches) -> Batches:
        for whole in whole_groups(batches, ["turn", "pa", "pb", "depth"], FLUSH):
            a, b = joined({c: whole.column(c).to_numpy().astype(np.int64) for c in whole.column_names}, bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=arrow)

    return rows.select("turn", "pa", "pb", "depth", "side", "v").mapInArrow(run, schema)


def split_pairs(pairs: DataFrame, step: int, bits: int) -> DataFrame:
    """Pairs of nodes ``step`` levels lower that are still within the budget of differing bits."""
    lower = F.least(F.lit(step), F.lit(64) - F.col("depth"))
    depth = F.col("depth") + lower
    own = F.expr(f"shiftrightunsigned(v, cast(64 - (depth + least({step}, 64 - depth)) as int))")
    deeper = pairs.withColumns({"own": own, "to": depth.cast("int"), "lower": lower.cast("int")})
    other = F.when(F.col("side") == 0, F.col("pb")).otherwise(F.col("pa"))
    masks = F.explode(F.expr(f"sequence(0L, {2**step - 1}L)"))
    deeper = deeper.select("*", other.alias("other"), masks.alias("low"))
    partner = F.expr("shiftleft(other, lower)").bitwiseOR(F.col("low"))
    deeper = deeper.where("low < shiftleft(1L, lower)").withColumn("partner", partner)
    deeper = deeper.where(F.bit_count(F.col("own").bitwiseXOR(F.col("partner"))) <= bits)
    same = F.col("pa") == F.col("pb")
    # below a node paired with itself, the smaller of two children is the first side
    first = F.when(same, F.col("own") <= F.col("partner")).otherwise(F.col("side") == 0)
    return deeper.select(
        "turn",
        F.col("to").alias("depth"),
        F.when(first, F.col("own")).otherwise(F.col("partner")).alias("pa"),
        F.when(first, F.col("partner")).otherwise(F.col("own")).alias("pb"),
        F.when(first, F.lit(0)).otherwise(F.lit(1)).alias("side"),
        "v",
    )


def joined(rows: dict[str, np.ndarray], most: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as fingerprints, of the links inside the given pairs of nodes."""
    value = rows["v"].view(np.uint64)
    order = np.lexsort((value, rows["side"], rows["depth"], rows["pb"], rows["pa"], rows["turn"]))
    rows = {k: x[order] for k, x in rows.items()}
    value, turn = rows["v"].view(np.uint64), rows["turn"].astype(np.uint64)
    back = np.uint64(BLOCK) * turn
    plain = np.where(turn > 0, (value >> back) | (value << ((np.uint64(64) - back) % np.uint64(64))), value)
    keys = np.stack([rows[c] for c in ("turn", "pa", "pb", "depth")])
    change = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)])
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(value))
    seconds = np.add.reduceat(rows["side"], start)
    middle = end - seconds
    own = rows["pa"][start] == rows["pb"][start]
    use = own | ((seconds > 0) & (middle > start))
    own, start, middle, end = own[use], start[use], middle[use], end[use]
    pairs = np.stack([start, np.where(own, end, middle), np.where(own, start, middle), end])
    differing = np.zeros(len(own), np.int64)
    root = np.arange(len(value))
    for bit in range(63 - BLOCK, -1, -1):
        if not pairs.shape[1]:
            break
        pairs, differing = compared_leaves(pairs, differing, value, root, most)
        pairs, differing = one_level(pairs, differing, value, bit, most)
    compared_leaves(pairs, differing, value, root, most, all_pairs=True)
    # what is one fingerprint may stand below several pairs of nodes
    far = np.flatnonzero(root != np.arange(len(root)))
    return plain[far].view(np.int64), plain[root[far]].view(np.int64)


def one_level(pairs: np.ndarray, differing: np.ndarray, value: np.ndarray, bit: int, most: int) -> tuple:
    """The pairs of children of all pairs of nodes; pairs over the budget of bits end here."""
    a0, a2, b0, b2 = pairs
    shift = np.uint64(bit)
    one = np.uint64(1)
    a1 = cut(value, a0, a2, shift, one)
    b1 = cut(value, b0, b2, shift, one)
    own = (a0 == b0) & (a2 == b2)
    children = [
        (a0, a1, b0, b1, differing, None),
        (a1, a2, b1, b2, differing, None),
        (a0, a1, b1, b2, differing + 1, None),
        (a1, a2, b0, b1, differing + 1, ~own),
    ]
    out, bits = [], []
    for x0, x1, y0, y1, d, where in children:
        keep = (x1 > x0) & (y1 > y0) & (d <= most)
        if where is not None:
            keep &= where
        # a fingerprint paired with itself is no link
        keep &= ~((x0 == y0) & (x1 == y1) & (x1 - x0 == 1))
        out.append(np.stack([x0[keep], x1[keep], y0[keep], y1[keep]]))
        bits.append(d[keep])
    return np.concatenate(out, 1), np.concatenate(bits)


def cut(value: np.ndarray, low: np.ndarray, high: np.ndarray, shift: np.uint64, one: np.uint64) -> np.ndarray:
    """Where the fingerprints of each node begin to have the bit set; a node's are sorted."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        is_set = (value[middle] >> shift) & one == one
        high[open_[is_set]] = middle[is_set]
        low[open_[~is_set]] = middle[~is_set] + 1


def compared_leaves(
    pairs: np.ndarray, differing: np.ndarray, value: np.ndarray, root: np.ndarray, most: int, all_pairs: bool = False
) -> tuple:
    """Compare the fingerprints of small pairs of nodes and join near ones; the other pairs."""
    a0, a1, b0, b1 = pairs
    size = (a1 - a0) * (b1 - b0)
    small = np.ones(len(size), bool) if all_pairs else size <= LEAF
    picked = np.flatnonzero(small)
    at = 0
    total = np.cumsum(size[picked])
    while at < len(picked):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + (1 << 20), "right")))
        some = picked[at:to]
        n = size[some]
        which = np.repeat(np.arange(len(some)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (b1 - b0)[some][which]
        i = a0[some][which] + place // width
        j = b0[some][which] + place % width
        near = (i != j) & (np.bitwise_count(value[i] ^ value[j]) <= most)
        unite(root, i[near], j[near])
        at = to
    return pairs[:, ~small], differing[~small]


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the sets of i and j; ``root`` points every place at the smallest of its set."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
