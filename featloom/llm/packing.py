"""Packing documents into sequences of a fixed length by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import map_batches, present, ship, text_bytes, to_arrow
from featloom.llm.tokens import END, WORD_BPE, token_ids
from featloom.session import checkpointed

CAPACITY = 4096
SHARD = 2048
"""Pieces packed together, on average."""
ISLANDS = 3
POPULATION = 4
GENERATIONS = 4
"""Crossovers of an island between two migrations."""
EPOCHS = 2
WELL_FILLED = 0.97
"""Share of a sequence from which on it is left alone when shards' remainders are packed again."""
ROUNDS = 3

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, rid long"
PLACED = PIECE + ", sequence_id long, offset long, fill long"


def pieces(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    vocabulary: str = WORD_BPE,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Every document's ids with an end id, cut every ``capacity`` ids; ``rid`` numbers the pieces.

    Null texts are empty: one piece with the end id alone. Equal rows are different documents.
    """
    end = END.to_bytes(4, "little")
    state = {"part": -1, "next": 0}

    def make(batch: pa.RecordBatch) -> dict:
        part = batch.column("part")[0].as_py()
        if state["part"] != part:
            state.update(part=part, next=part << 40)
        out: dict[str, list] = {n: [] for n in names}
        for number, data in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
            ids = token_ids(data, vocabulary) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part_ids = ids[at : at + 4 * capacity]
                values = (number, k, at // 4, len(part_ids) // 4, zlib.crc32(part_ids), state["next"])
                for n, v in zip(names, values, strict=True):
                    out[n].append(v)
                state["next"] += 1
        return out

    names = ("doc_id", "piece", "start", "length", "ids_crc32", "rid")
    columns = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        present(text).alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    return checkpointed(map_batches(columns, make, PIECE))


def packed(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    vocabulary: str = WORD_BPE,
    capacity: int = CAPACITY,
) -> DataFrame:
    """All pieces with sequence_id and offset, in as few sequences of ``capacity`` ids as can be."""
    rows = pieces(docs, text, doc_id, vocabulary, capacity)
    return pack(rows, capacity).drop("rid", "fill")


def pack(rows: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``rows`` of ``pieces`` with sequence_id, offset and fill, the length of the sequence.

    Full pieces are sequences of their own. The others are dealt over shards of about ``shard``
    pieces, each packed by several islands of solutions. What lies in badly filled sequences is
    dealt again over fewer shards, ``ROUNDS`` times in all.
    """
    full = rows.where(F.col("length") >= capacity).select(
        "*",
        (-F.col("rid") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").alias("fill"),
    )
    done, rest, first = [full], rows.where(F.col("length") < capacity), 0
    for turn in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        shards = -(-n // shard)
        key = F.pmod(F.xxhash64(F.lit(turn), "rid"), F.lit(shards)) + F.lit(first)
        placed = checkpointed(placed_pieces(rest.select("*", key.alias("shard")), capacity))
        first += shards
        last = turn == ROUNDS - 1 or shards == 1
        good = F.lit(True) if last else F.col("fill") >= int(WELL_FILLED * capacity)
        done.append(placed.where(good))
        if last:
            break
        rest = placed.where(~good).drop("sequence_id", "offset", "fill")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def placed_pieces(rows: DataFrame, capacity: int) -> DataFrame:
    """The pieces of every shard, placed by the best solution of its islands."""
    spark = rows.sparkSession
    ship(spark)
    schema = "shard long, island int, lengths binary, people binary"
    arrow, placed = to_arrow(spark, schema), to_arrow(spark, PLACED)

    def start(key: tuple, part: pa.Table) -> pa.Table:
        lengths = in_order(part).column("length").to_numpy().astype(np.int32)
        made = [
            first_people(lengths, capacity, key[0].as_py() * ISLANDS + i) for i in range(ISLANDS)
        ]
        values = (
            [key[0].as_py()] * ISLANDS,
            list(range(ISLANDS)),
            [lengths.tobytes()] * ISLANDS,
            [np.stack(x).astype(np.int32).tobytes() for x in made],
        )
        return pa.Table.from_arrays(
            [pa.array(v, f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow
        )

    islands = checkpointed(rows.groupBy("shard").applyInArrow(start, schema))
    for epoch in range(EPOCHS):
        islands = checkpointed(evolved(islands, capacity, epoch))
    best = islands.groupBy("shard").agg(
        F.max_by("people", F.struct("fitness", -F.col("island"))).alias("people")
    )

    def place(key: tuple, part: pa.Table, found: pa.Table) -> pa.Table:
        part = in_order(part)
        n = part.num_rows
        bins = np.frombuffer(found.column("people")[0].as_py(), np.int32)[:n].astype(np.int64)
        lengths = part.column("length").to_numpy()
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        sorted_bins = bins[order]
        head = np.concatenate([[True], sorted_bins[1:] != sorted_bins[:-1]])
        base = (ends - lengths[order])[head][np.cumsum(head) - 1]
        offset = np.empty(n, np.int64)
        offset[order] = ends - lengths[order] - base
        fill = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        columns = [part.column(f.name) for f in placed if f.name in part.column_names]
        extra = [pa.array((key[0].as_py() << 24) + bins), pa.array(offset), pa.array(fill)]
        return pa.Table.from_arrays([*columns, *extra], schema=placed)

    both = rows.groupBy("shard").cogroup(best.groupBy("shard"))
    return both.applyInArrow(place, PLACED)


def in_order(part: pa.Table) -> pa.Table:
    """A shard's pieces in the order of their numbers."""
    return part.sort_by("rid").combine_chunks()


def evolved(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Every island after ``GENERATIONS`` crossovers, with the elite that its neighbour sent."""
    sender = islands.select(
        "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("people").alias("guests")
    )
    rows = islands.drop("fitness").join(sender, ["shard", "island"]) if epoch else islands.withColumn(
        "guests", F.lit(None).cast("binary")
    )

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("shard", "island", "lengths", "people", "fitness")}
        for row in batch.to_pylist():
            lengths = np.frombuffer(row["lengths"], np.int32)
            people = list(np.frombuffer(row["people"], np.int32).reshape(-1, len(lengths)))
            if row["guests"]:
                # the best comes first on every island
                people[-1] = np.frombuffer(row["guests"], np.int32)[: len(lengths)]
            rng = Random(f"{row['shard']} {row['island']} {epoch}")
            people = generations(lengths, people, capacity, rng)
            out["people"].append(np.stack(people).astype(np.int32).tobytes())
            out["fitness"].append(fitness(lengths, people[0], capacity))
            for n in ("shard", "island", "lengths"):
                out[n].append(row[n])
        return out

    schema = "shard long, island int, lengths binary, people binary, fitness double"
    return map_batches(rows, make, schema)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> float:
    """Fewer sequences first; then a few very empty ones rather than many slightly empty."""
    fill = np.bincount(bins, weights=lengths)
    fill = fill[fill > 0]
    return -len(fill) + float(np.mean((fill / capacity) ** 2))


def first_people(lengths: np.ndarray, capacity: int, seed: int) -> list[np.ndarray]:
    """Solutions to begin with: best fit by falling length, and by slightly shuffled lengths."""
    rng = np.random.default_rng(seed)
    made = []
    for k in range(POPULATION):
        noise = 1 + 0.05 * k * rng.standard_normal(len(lengths))
        order = np.argsort(-lengths * noise, kind="stable").tolist()
        bins = np.zeros(len(lengths), np.int32)
        best_fit(lengths.tolist(), order, bins, [], capacity, 0)
        made.append(bins)
    return sorted(made, key=lambda b: -fitness(lengths, b, capacity))


def best_fit(
    lengths: list[int],
    order: list[int],
    bins: np.ndarray,
    room: list[tuple[int, int]],
    capacity: int,
    new: int,
) -> None:
    """Put the pieces in ``order`` where the least room is left over; ``room`` is (room, bin) sorted."""
    for item in order:
        need = lengths[item]
        at = bisect_left(room, (need, -1))
        if at < len(room):
            left, where = room.pop(at)
        else:
            left, where, new = capacity, new, new + 1
        bins[item] = where
        if left > need:
            insort(room, (left - need, where))


def generations(
    lengths: np.ndarray, people: list[np.ndarray], capacity: int, rng: Random
) -> list[np.ndarray]:
    """The solutions after some crossovers, the best first; a worse child replaces nobody."""
    scored = sorted(((fitness(lengths, b, capacity), i, b) for i, b in enumerate(people)), reverse=True)
    least = -(-int(lengths.sum()) // capacity)
    for turn in range(GENERATIONS):
        if -scored[0][0] <= least:
            break
        giver, taker = rng.sample(range(len(scored)), 2) if len(scored) > 1 else (0, 0)
        child = crossed(lengths, scored[taker][2], scored[giver][2], capacity, rng)
        score = fitness(lengths, child, capacity)
        if score > scored[-1][0]:
            scored[-1] = (score, len(people) + turn, child)
            scored.sort(reverse=True)
    return [b for _, _, b in scored]


def crossed(
    lengths: np.ndarray, taker: np.ndarray, giver: np.ndarray, capacity: int, rng: Random
) -> np.ndarray:
    """A child of two solutions.

    Whole well-filled sequences of the giver are put into the taker. Sequences of the taker that
    share a piece with them are dissolved, and one of its emptiest too; pieces left over go where
    they fit best.
    """
    fill = np.bincount(giver, weights=lengths)
    ranked = np.argsort(-fill, kind="stable")[: max(1, int((fill > 0).sum() // 2))]
    share = rng.randint(1, max(1, len(ranked)))
    chosen = np.zeros(len(fill), bool)
    chosen[[int(x) for x in rng.sample(list(ranked), share)]] = True
    injected = chosen[giver]
    own = np.bincount(taker, weights=lengths)
    gone = np.zeros(len(own), bool)
    gone[taker[injected]] = True
    gone[np.argsort(np.where(own > 0, own, np.inf), kind="stable")[: 1 + len(own) // 50]] = True
    stays = ~injected & ~gone[taker]
    child = np.where(injected, giver, -1).astype(np.int32)
    child[stays] = taker[stays] + len(fill)
    _, dense = np.unique(child[child >= 0], return_inverse=True)
    child[child >= 0] = dense
    used = int(dense.max()) + 1 if len(dense) else 0
    placed = child >= 0
    left = capacity - np.bincount(child[placed], weights=lengths[placed], minlength=used).astype(np.int64)
    room = sorted((int(r), b) for b, r in enumerate(left) if r > 0)
    loose = np.flatnonzero(~placed)
    order = loose[np.argsort(-lengths[loose], kind="stable")].tolist()
    best_fit(lengths.tolist(), order, child, room, capacity, used)
    return child
