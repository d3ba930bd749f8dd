"""A hierarchical Pitman-Yor language model over words, with seatings sampled by Gibbs.

The restaurant of a context, the word before, has the restaurant of all words as its parent, and that one
a uniform base over the words known and one more. Customers are tokens; each table of a context sends one
customer to the parent. Words and contexts are known by their 64-bit hash; every word before has a
restaurant of its own, and neither words nor contexts are cut.

How the work is spread. Texts are read in blocks. A block counts its (word, context) pairs and sends
them to buckets: a range of words, split by context so that a frequent word is spread over several. Buckets
know the pairs, and tables by pair; what belongs to a word or a context as a whole is summed in shards of
keys, a table that is joined by key: a bucket sends a shard one number for each key it has, however often
the key occurs, and gets the totals back. Sweeps and this exchange alternate, with the seatings written in
between. In the end every bucket gives each block the probabilities of the pairs the block asked for, and
blocks add them up by document. Where so many blocks ask that a bucket gets large, its questions are dealt to
several tasks, which add up their counts first; the sum has each pair once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm.common import Batches, map_batches, present, ship, text_bytes, to_arrow
from featloom.session import checkpointed, delete_path, scratch_path, shuffles_dropped

START = np.uint64(0x57A257A257A257A2)
END = np.uint64(0xE0D0E0D0E0D0E0D0)
BLOCK = 8_000_000
"""Bytes of text after which a block ends."""
BUCKET = 2_000_000
"""Bytes of text for each bucket of words."""
SHARD = 16_000_000
"""Bytes of text for each shard of words or contexts."""
HOT_BUCKET = 64_000_000
"""Bytes of a bucket's questions above which they are dealt to several tasks."""
SLICES = 4
"""Buckets are put together, and give their probabilities, a slice of them after the other."""
FOLDS, HELD = 7, 2
BURN_IN = 2
SAMPLES = 3
MOST_PASSES = 12
SETTLED = 0.01
"""Passes end when all tables together change by less than this share, after burn-in and samples."""
SINGLE_STEPS = 16
"""Customers of a dish that are seated one by one; then seating jumps from new table to new table."""
KEY_BITS = 63
"""Bits of a sorted number; pairs and documents that need more are numbered first."""
FEW = 16
"""Dishes that still jump from which on they are seated number by number."""
STRENGTH = 1.0

USES, COUNTS = "uses", "counts"
WORDS, CONTEXTS = 0, 1


class Totals(NamedTuple):
    """What all restaurants together know of the parent, and the discounts."""

    parent_customers: int
    parent_tables: int
    words: int
    discount: float
    parent_discount: float


def is_held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; an unknown id counts as an empty text."""
    text = b"" if doc_id is None else str(doc_id).encode()
    return zlib.crc32(text) % FOLDS == HELD


def word_hashes(text: bytes) -> np.ndarray:
    """A number for every token: words with A-Z as a-z, and the end."""
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8")
    out[-1] = END
    return out


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of hashes that a key is in, of so many of equal size."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def bucket_of(words: np.ndarray, contexts: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each pair: a range of words, split by other bits of the context."""
    split = math.isqrt(buckets) // 4 or 1
    return part_of(words, -(-buckets // split)) * split + part_of(contexts << np.uint64(32), split)


PRESS, OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
"""Made once in each worker: there are very many small messages."""


def pressed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed piece, each with its bytes sorted by rank."""
    parts = [len(arrays).to_bytes(4, "little")]
    for x in arrays:
        kind = x.dtype.str.encode()
        raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize)
        planes = [raw[:, k].tobytes() for k in range(x.itemsize)]
        parts += [len(kind).to_bytes(4, "little"), kind, raw.size.to_bytes(8, "little"), *planes]
    return PRESS.compress(b"".join(parts))


def opened(data: bytes) -> list[np.ndarray]:
    """The arrays of ``pressed``."""
    raw = OPEN.decompress(data)
    out, at = [], 4
    for _ in range(int.from_bytes(raw[:4], "little")):
        size = int.from_bytes(raw[at : at + 4], "little")
        kind = np.dtype(raw[at + 4 : at + 4 + size].decode())
        at += 4 + size
        size = int.from_bytes(raw[at : at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, size, at + 8).reshape(kind.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 8 + size
    return out


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], rank[coded.indices.to_numpy()]


def block_rows(block: int, ids: list, texts: list[bytes], buckets: int) -> list[tuple]:
    """What a block keeps for itself, and what it sends to every bucket."""
    tokens = [word_hashes(text) for text in texts]
    lengths = np.array([len(t) for t in tokens])
    held = np.array([is_held_out(i) for i in ids])
    doc = np.repeat(np.arange(len(ids)), lengths)
    words, index = numbered(np.concatenate(tokens))
    contexts = np.union1d(words, [START])
    place = np.empty_like(index)
    place[1:] = np.searchsorted(contexts, words)[index[:-1]]
    place[np.cumsum(lengths) - lengths] = np.searchsorted(contexts, START)
    pair, pairs = index * len(contexts) + place, None
    doc_bits = max(1, int(len(ids) - 1).bit_length())
    if (len(words) * len(contexts)).bit_length() + doc_bits > KEY_BITS:
        pairs, pair = np.unique(pair, return_inverse=True)
    # one sort by pair and document; then the pairs, each with its entries, come in the order of buckets
    key, times = np.unique((pair << doc_bits) | doc, return_counts=True)
    pair, doc = key >> doc_bits, key & ((1 << doc_bits) - 1)
    head = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    entries = np.diff(np.append(head, len(pair)))
    trained = np.add.reduceat(np.where(held[doc], 0, times), head)
    pair = pair[head] if pairs is None else pairs[pair[head]]
    word, context = words[pair // len(contexts)], contexts[pair % len(contexts)]
    bucket = bucket_of(word, context, buckets)
    order = np.argsort(bucket, kind="stable")
    word, context, bucket, trained, head, entries = (x[order] for x in (word, context, bucket, trained, head, entries))
    at = np.arange(len(doc)) + np.repeat(head - (np.cumsum(entries) - entries), entries)
    doc, times = doc[at], times[at]
    change = bucket[1:] != bucket[:-1]
    run = np.flatnonzero(np.concatenate([[True], change | (word[1:] != word[:-1])]))
    pairs_of_run = np.diff(np.append(run, len(word)))
    own = pressed(entries.astype("<u4"), doc.astype("<u4"), times.astype("<u4"), pairs_of_run.astype("<u4"))
    known = np.array([i is not None for i in ids])
    numbers = np.array([i or 0 for i in ids], "<i8")
    about = pressed(numbers, known.astype("u1"), held.astype("u1"), lengths.astype("<i8"))
    rows = [(block, -1, own, about)]
    edge = np.flatnonzero(np.concatenate([[True], change]))
    for x, y in zip(edge, np.append(edge[1:], len(word)), strict=True):
        a, b = np.searchsorted(run, [x, y])
        asked = pressed(
            word[run[a:b]].astype("<u8"),
            pairs_of_run[a:b].astype("<u4"),
            context[x:y].astype("<u8"),
            trained[x:y].astype("<u4"),
        )
        rows.append((block, int(bucket[x]), asked, None))
    return rows


def counted(docs: DataFrame, text: str, doc_id: str, buckets: int) -> str:
    """Write what blocks keep and what they send, and return the folder."""
    spark = docs.sparkSession
    ship(spark)
    schema = "block long, bucket int, data binary, about binary"
    arrow = to_arrow(spark, schema)

    def run(batches: Batches) -> Batches:
        ids: list = []
        texts: list[bytes] = []
        size, made, part = 0, 0, 0

        def close() -> pa.RecordBatch:
            rows = block_rows((part << 24) + made, ids, texts, buckets)
            columns = zip(*rows, strict=True)
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            numbers = batch.column("doc_id").to_pylist()
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for number, data in zip(numbers, text_bytes(batch), strict=True):
                ids.append(number)
                texts.append(data)
                size += len(data)
                if size >= BLOCK:
                    yield close()
                    ids, texts, size, made = [], [], 0, made + 1
        if ids:
            yield close()

    columns = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        present(text).alias("text"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    kind = F.when(F.col("bucket") < 0, USES).otherwise(COUNTS)
    folder = scratch_path(spark, "blocks")
    rows = columns.mapInArrow(run, schema).withColumns({"kind": kind, "slice": slice_of("bucket")})
    rows.write.partitionBy("kind", "slice").parquet(folder)
    return folder


def slice_of(bucket: str) -> Column:
    """The slice that a bucket is in."""
    return F.pmod(bucket, F.lit(SLICES))


def stored(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """One kind of the rows that blocks wrote."""
    schema = "block long, bucket int, data binary, about binary, kind string, slice int"
    return spark.read.schema(schema).parquet(folder).where(F.col("kind") == kind)


def in_buckets(spark: SparkSession, folder: str, hot_bytes: int = HOT_BUCKET) -> tuple[str, str]:
    """Folders of each bucket of pairs; and of who asked a bucket for which of its pairs, in one row or several.

    A bucket with several rows of questions has with each of them a link from its places to the whole's.
    What blocks sent is deleted slice by slice, so that never all of it is there twice.
    """
    rows = stored(spark, folder, COUNTS).select("block", "bucket", "data")
    sizes = rows.groupBy("bucket").agg(F.sum(F.octet_length("data")).alias("size"))
    hot = checkpointed(
        sizes.where(F.col("size") > hot_bytes).select(
            F.col("bucket").alias("hot"), F.ceil(F.col("size") / hot_bytes).alias("parts")
        )
    )
    schema = "bucket int, part long, blocks array<long>, places array<binary>, whole binary, once long, twice long"
    arrow = to_arrow(spark, schema)

    def gather(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by("block").combine_chunks()
        bucket = Bucket(part.column("data").to_pylist())
        places = [pressed(w.astype("<u4"), p.astype("<u4")) for w, p in bucket.places()]
        row = key[0].as_py(), key[1].as_py(), part.column("block").to_pylist(), places, bucket.as_question()
        row += bucket.times(1), bucket.times(2)
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    names = ["bucket", "whole", "once", "twice"]
    whole_path, question_path = scratch_path(spark, "wholes"), scratch_path(spark, "questions")
    any_hot = not hot.isEmpty()
    for k in range(SLICES):
        rows = stored(spark, folder, COUNTS).where(F.col("slice") == k).select("block", "bucket", "data")
        dealt = rows.join(F.broadcast(hot), rows["bucket"] == hot["hot"], "left")
        dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("block"), F.col("parts")), F.lit(-1)))
        found = dealt.select("block", "bucket", "data", "part").groupBy("bucket", "part").applyInArrow(gather, schema)
        made = scratch_path(spark, "buckets")
        found.write.parquet(made)
        # what blocks sent to these buckets is in them now
        delete_path(spark, f"{folder}/kind={COUNTS}/slice={k}")
        parts = spark.read.schema(found.schema).parquet(made)
        wholes, questions = parts.where("part < 0").select(*names), parts.select("bucket", "part", "blocks", "places")
        if any_hot:
            more, links = added_up(parts)
            wholes = wholes.unionByName(more.select(*names))
            questions = questions.join(links, ["bucket", "part"], "left")
        else:
            questions = questions.withColumn("link", F.lit(None).cast("binary"))
        wholes.write.parquet(f"{whole_path}/slice={k}")
        questions.write.parquet(f"{question_path}/slice={k}")
        delete_path(spark, made)
    return whole_path, question_path


WHOLES = "bucket int, whole binary, once long, twice long, slice int"
QUESTIONS = "bucket int, part long, blocks array<long>, places array<binary>, link binary, slice int"


def added_up(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The buckets whose questions were dealt to several tasks, and the links of these questions."""
    merged = "bucket int, part long, whole binary, once long, twice long, link binary"
    kinds = to_arrow(parts.sparkSession, merged)

    def add_up(key: tuple, part: pa.Table) -> pa.Table:
        asked = part.column("whole").to_pylist()
        bucket = Bucket(asked)
        number = key[0].as_py()
        found = [(number, -1, bucket.as_question(), bucket.times(1), bucket.times(2), None)]
        for at, (word, pair) in zip(part.column("part").to_pylist(), bucket.places(), strict=True):
            found.append((number, at, None, None, None, pressed(word.astype("<u4"), pair.astype("<u4"))))
        columns = zip(*found, strict=True)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

    split = parts.where("part >= 0").select("bucket", "part", "whole").groupBy("bucket")
    split = checkpointed(split.applyInArrow(add_up, merged))
    return split.where("part < 0"), split.where("part >= 0").select("bucket", "part", "link")


class Bucket:
    """The words of a bucket with all their pairs, put together from all blocks."""

    def __init__(self, asked: list[bytes]) -> None:
        parts = [opened(x) for x in asked]
        self.n_words = [len(p[0]) for p in parts]
        self.n_pairs = [len(p[2]) for p in parts]
        self.words, self.word_at = parts[0][0], np.arange(len(parts[0][0]))
        if len(parts) > 1:
            self.words, self.word_at = numbered(np.concatenate([p[0] for p in parts]))
        of = np.repeat(self.word_at, np.concatenate([p[1] for p in parts]).astype(np.int64))
        self.contexts, context = numbered(np.concatenate([p[2] for p in parts]))
        pairs, self.pair_at = of * len(self.contexts) + context, np.arange(len(of))
        if len(parts) > 1:
            pairs, self.pair_at = np.unique(pairs, return_inverse=True)
        times = np.concatenate([p[3] for p in parts])
        self.count = np.bincount(self.pair_at, weights=times, minlength=len(pairs)).astype(np.int64)
        self.word, self.context = pairs // len(self.contexts), pairs % len(self.contexts)

    def as_question(self) -> bytes:
        """The bucket in the form in which a block sends its part of it."""
        pairs = np.bincount(self.word, minlength=len(self.words))
        contexts = self.contexts[self.context]
        return pressed(
            self.words.astype("<u8"), pairs.astype("<u4"), contexts.astype("<u8"), self.count.astype("<u8")
        )

    def places(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Where the words and pairs of each part are."""
        words = np.split(self.word_at, np.cumsum(self.n_words)[:-1])
        return list(zip(words, np.split(self.pair_at, np.cumsum(self.n_pairs)[:-1]), strict=True))

    def keys(self, kind: int) -> list[np.ndarray]:
        """The keys of a kind."""
        return [(self.words, self.contexts)[kind]]

    def times(self, n: int) -> int:
        """How many pairs were seen so many times."""
        return int((self.count == n).sum())

    def sums(self, kind: int) -> list[np.ndarray]:
        """The keys of a kind with their customers, and their pairs that were seen."""
        keys, of = ((self.words, self.word), (self.contexts, self.context))[kind]
        customers = np.bincount(of, weights=self.count, minlength=len(keys))
        return [keys, customers.astype("<i8"), np.bincount(of, self.count > 0, len(keys)).astype("<i8")]


class Seating:
    """The pairs of a bucket seen more than once, with their tables in the last seatings.

    A pair with one customer has one table, whatever is sampled, and is known to the shards alone.
    """

    def __init__(self, data: bytes) -> None:
        self.keys = [None, None]
        self.keys[WORDS], self.keys[CONTEXTS], *rest = opened(data)
        self.word, self.context, self.count, *self.tables = (x.astype(np.int64) for x in rest)

    @staticmethod
    def of(bucket: Bucket) -> bytes:
        """The first seating: every pair has one table."""
        more = bucket.count > 1
        words, word = np.unique(bucket.word[more], return_inverse=True)
        contexts, context = np.unique(bucket.context[more], return_inverse=True)
        numbers = word.astype("<u4"), context.astype("<u4"), bucket.count[more].astype("<u8")
        ones = np.ones(len(word), "<u4")
        return pressed(bucket.words[words].astype("<u8"), bucket.contexts[contexts].astype("<u8"), *numbers, ones)

    def extra(self, kind: int, last: int) -> list[np.ndarray]:
        """The keys of a kind with their tables beyond one a pair, in each of the last seatings."""
        of = (self.word, self.context)[kind]
        keys = self.keys[kind]
        return [keys, *(np.bincount(of, t - 1, len(keys)).astype("<i8") for t in self.tables[-last:])]

    def swept(self, sent: np.ndarray, parent_tables: np.ndarray, tables: np.ndarray, totals: Totals, seed: int) -> bytes:
        """Unseat the customers of every pair and seat them again, against totals by word and context."""
        above = above_of(sent, parent_tables, totals)[self.word]
        others = np.maximum(tables[self.context] - self.tables[-1], 0)
        new = seated(self.count, above, others, totals.discount, np.random.default_rng(seed))
        kept = [t.astype("<u4") for t in [*self.tables, new][-SAMPLES:]]
        numbers = self.word.astype("<u4"), self.context.astype("<u4"), self.count.astype("<u8")
        return pressed(self.keys[WORDS], self.keys[CONTEXTS], *numbers, *kept)


def above_of(sent: np.ndarray, parent_tables: np.ndarray, totals: Totals) -> np.ndarray:
    """The parent's probability of words, a word it has not seen included."""
    mass = sent - totals.parent_discount * parent_tables
    return (mass + new_mass(totals)) / (STRENGTH + totals.parent_customers)


def new_mass(totals: Totals) -> float:
    """What the parent gives to its own base, for one word."""
    return (STRENGTH + totals.parent_discount * totals.parent_tables) / (totals.words + 1)


def seated(
    count: np.ndarray, above: np.ndarray, others: np.ndarray, discount: float, random: np.random.Generator
) -> np.ndarray:
    """Tables after seating ``count`` customers of a dish, given all other dishes' tables.

    The next customer takes a new table in proportion to (strength + discount * tables) * above, and an
    old one to customers - discount * tables of the dish. After ``SINGLE_STEPS`` customers, the number
    seated until the next new table is drawn at once: the chance that none has come falls as a power.
    """
    tables = np.ones(len(count), np.int64)
    at = np.arange(len(count))
    for seats in range(1, min(SINGLE_STEPS, int(count.max(initial=1)))):
        at = at[count[at] > seats]
        new = (STRENGTH + discount * (others[at] + tables[at])) * above[at]
        old = seats - discount * tables[at]
        tables[at] += random.random(len(at)) * (new + old) < new
    at = np.flatnonzero(count > SINGLE_STEPS)
    seats = np.full(len(at), float(SINGLE_STEPS))
    while len(at) > FEW:
        new = (STRENGTH + discount * (others[at] + tables[at])) * above[at]
        old = seats - discount * tables[at] + new / 2
        with np.errstate(over="ignore"):
            seats = seats + np.ceil(old * (random.random(len(at)) ** (-1 / new) - 1) + 1e-9)
        more = seats <= count[at]
        at, seats = at[more], seats[more]
        tables[at] += 1
    seat_few(tables, at, seats, count, above, others, discount, random)
    return tables


def seat_few(
    tables: np.ndarray,
    at: np.ndarray,
    seats: np.ndarray,
    count: np.ndarray,
    above: np.ndarray,
    others: np.ndarray,
    discount: float,
    random: np.random.Generator,
) -> None:
    """The last jumps of ``seated``, for few dishes with very many tables: number by number, with the same draws."""
    rest = list(zip(at.tolist(), *(x[at].tolist() for x in (count, above, others, tables)), seats.tolist(), strict=True))
    while rest:
        going = []
        for (k, most, share, other, own, seat), draw in zip(rest, random.random(len(rest)).tolist(), strict=True):
            new = (STRENGTH + discount * (other + own)) * share
            old = seat - discount * own + new / 2
            try:
                seat += math.ceil(old * (draw ** (-1 / new) - 1) + 1e-9)
            except (OverflowError, ZeroDivisionError):
                continue
            if seat <= most:
                tables[k] += 1
                going.append((k, most, share, other, own + 1, seat))
        rest = going


MESSAGE = "shard int, bucket int, what int, data binary"
STATIC, ADDS, ASKS, BOTH = range(4)
"""Totals of a shard; what a bucket adds to them; for which keys it asks; both."""


def by_shard(arrays: list[np.ndarray], kind: int, shards: int) -> list[tuple[int, bytes]]:
    """Arrays along sorted keys cut by the shards of the keys; words and contexts have shards of their own."""
    part = part_of(arrays[0], shards)
    edge = np.flatnonzero(np.concatenate([part[:1] >= 0, part[1:] != part[:-1]]))
    ends = np.append(edge[1:], len(part))
    return [
        (int(part[x]) * 2 + kind, pressed(*(a[x:y] for a in arrays))) for x, y in zip(edge, ends, strict=True)
    ]


def sent_out(rows: DataFrame, column: str, make: Callable[[bytes], Callable[[int], list[np.ndarray]]], what: int, shards: int) -> DataFrame:
    """What ``make`` says of the words and contexts of each bucket, as messages to the shards."""
    arrow = to_arrow(rows.sparkSession, MESSAGE)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column(column).to_pylist(), strict=True):
                state = make(data)
                found = [m for kind in (WORDS, CONTEXTS) for m in by_shard(state(kind), kind, shards)]
                if found:
                    names, messages = zip(*found, strict=True)
                    n = len(found)
                    arrays = [names, [bucket] * n, [what] * n, messages]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(arrays, arrow, strict=True)], schema=arrow
                    )

    return rows.select("bucket", column).mapInArrow(run, MESSAGE)


def shard_totals(wholes: DataFrame, shards: int) -> DataFrame:
    """By shard the sorted keys, with their customers and pairs in all buckets; what is known of the words."""
    messages = sent_out(wholes, "whole", lambda data: Bucket([data]).sums, ADDS, shards)
    schema = f"{MESSAGE}, words long, once long, twice long, customers long"
    arrow = to_arrow(wholes.sparkSession, schema)

    def add_up(key: tuple, part: pa.Table) -> pa.Table:
        parts = [opened(x) for x in part.column("data").to_pylist()]
        keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        customers, pairs = (
            np.bincount(at, np.concatenate([p[k] for p in parts]), len(keys)).astype("<i8") for k in (1, 2)
        )
        row = [key[0].as_py(), None, STATIC, pressed(keys, customers, pairs)]
        if row[0] % 2 == WORDS:
            row += [int((pairs > 0).sum()), int((pairs == 1).sum()), int((pairs == 2).sum()), int(customers.sum())]
        else:
            row += [0] * 4
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    return checkpointed(messages.groupBy("shard").applyInArrow(add_up, schema))


def exchanged(static: DataFrame, messages: DataFrame, totals: Totals, samples: int, seed: int) -> tuple[DataFrame, str]:
    """Replies to what buckets ask, and their folder: by word customers, and in each seating its customers and tables in the parent;
    by context customers, and in each seating its tables. Each shard of words also says what it sums up to.
    """
    schema = f"{MESSAGE}, sent array<long>, tables array<long>"
    arrow = to_arrow(static.sparkSession, schema)

    def reply(key: tuple, part: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        own = [[], [], []]
        for what, bucket, data in zip(*(part.column(n).to_pylist() for n in ("what", "bucket", "data")), strict=True):
            if what == STATIC:
                keys, customers, pairs = opened(data)
                values = [pairs.copy() for _ in range(samples)]
            else:
                own[what - 1].append((bucket, opened(data)))
        adds, asks, both = own
        for _, (found, *extra) in adds + both:
            at = np.searchsorted(keys, found)
            for value, more in zip(values, extra, strict=True):
                value[at] += more
        answers, sums = [customers, *values], ([], [])
        if shard % 2 == WORDS:
            base = np.full(len(keys), 1 / (totals.words + 1))
            answers = [customers]
            for k, sent in enumerate(values):
                random = np.random.default_rng([seed, shard, k])
                known = sent > 0
                tables = known.astype(np.int64)
                # the first draw stands for the seating before, which is taken off the total in the second
                for _ in range(2):
                    others = np.maximum(totals.parent_tables - tables, 0)[known]
                    tables[known] = seated(sent[known], base[known], others, totals.parent_discount, random)
                answers += [sent, tables]
                sums[0].append(int(sent.sum()))
                sums[1].append(int(tables.sum()))
        rows = [(shard, -1, STATIC, None, *sums)]
        for bucket, (found, *_) in asks + both:
            at = np.searchsorted(keys, found)
            rows.append((shard, bucket, STATIC, pressed(*(x[at].astype("<u8") for x in answers)), None, None))
        columns = zip(*rows, strict=True)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    names = ["shard", "bucket", "what", "data"]
    asked = static.select(*names).unionByName(messages.select(*names))
    found = asked.groupBy("shard").applyInArrow(reply, schema)
    path = scratch_path(static.sparkSession, "replies")
    found.write.parquet(path)
    return static.sparkSession.read.schema(found.schema).parquet(path), path


def sums_of(replies: DataFrame, totals: Totals, samples: int) -> list[Totals]:
    """The totals of the parent in each seating."""
    found = replies.where("bucket < 0").select(F.posexplode(F.arrays_zip("sent", "tables")).alias("k", "x"))
    sums = {k: x for k, *x in found.groupBy("k").agg(F.sum("x.sent"), F.sum("x.tables")).collect()}
    found = (sums.get(k, (0, 0)) for k in range(samples))
    return [totals._replace(parent_customers=sent, parent_tables=tables) for sent, tables in found]


def replies_in(part: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The replies to a bucket along its words and along its contexts."""
    part = part.filter(pc.equal(part.column("what"), STATIC)).sort_by("shard")
    found = [[], []]
    for shard, data in zip(part.column("shard").to_pylist(), part.column("data").to_pylist(), strict=True):
        found[shard % 2].append([x.astype(np.int64) for x in opened(data)])
    words, contexts = ([np.concatenate(x) for x in zip(*kind, strict=True)] for kind in found)
    return words, contexts


SEATS, WHOLE = 1, 2
SEATINGS = "bucket int, seats binary"
LOGS = "bucket int, logs binary, counts binary"


def as_rows(frame: DataFrame, column: str, what: int) -> DataFrame:
    """Rows of buckets in the form of replies."""
    return frame.select(F.lit(-1).alias("shard"), "bucket", F.lit(what).alias("what"), F.col(column).alias("data"))


def data_of(part: pa.Table, what: int) -> bytes:
    """The one row of a kind."""
    return part.filter(pc.equal(part.column("what"), what)).column("data")[0].as_py()


def first_seats(wholes: DataFrame) -> DataFrame:
    """The first seating of every bucket that has a pair seen more than once."""

    def make(batch: pa.RecordBatch) -> dict:
        buckets = [Bucket([x]) for x in batch.column("whole").to_pylist()]
        kept = [(k, Seating.of(b)) for k, b in zip(batch.column("bucket").to_pylist(), buckets, strict=True) if b.count.max() > 1]
        return {"bucket": [k for k, _ in kept], "seats": [x for _, x in kept]}

    return map_batches(wholes.select("bucket", "whole"), make, SEATINGS)


def seats_after(seats: DataFrame, replies: DataFrame, totals: Totals, seed: int) -> DataFrame:
    """The seatings after one more sweep."""
    arrow = to_arrow(seats.sparkSession, SEATINGS)

    def sweep(key: tuple, part: pa.Table) -> pa.Table:
        state = Seating(data_of(part, SEATS))
        (_, sent, parent_tables), (_, tables) = replies_in(part)
        number = key[0].as_py()
        row = number, state.swept(sent, parent_tables, tables, totals, [seed, number])
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    rows = replies.where("bucket >= 0").select("shard", "bucket", "what", "data")
    return rows.unionByName(as_rows(seats, "seats", SEATS)).groupBy("bucket").applyInArrow(sweep, SEATINGS)


def settled(static: DataFrame, wholes: DataFrame, totals: Totals, shards: int) -> tuple[str, Totals, int]:
    """The folder of the last seatings, written after every pass; the totals, and the number of passes.

    A pass sums up the tables of all buckets by word and context, and sweeps every bucket against them.
    Passes end when burn-in and samples are done and all tables together change little, or at ``MOST_PASSES``.
    """
    spark = wholes.sparkSession
    folder = scratch_path(spark, "seats")
    frame = first_seats(wholes)
    frame.write.parquet(folder)
    before = 0
    for number in range(MOST_PASSES + 1):
        seats = spark.read.schema(frame.schema).parquet(folder)
        moves = abs(totals.parent_customers - before) > SETTLED * totals.parent_customers
        if number == MOST_PASSES or number >= BURN_IN + SAMPLES and not moves:
            return folder, totals, number
        messages = sent_out(seats, "seats", extra_of(1), BOTH, shards)
        replies, path = exchanged(static, messages, totals, 1, number)
        before = totals.parent_customers
        totals = sums_of(replies, totals, 1)[0]
        after = scratch_path(spark, "seats")
        seats_after(seats, replies, totals, number).write.parquet(after)
        delete_path(spark, folder)
        delete_path(spark, path)
        folder = after
    raise AssertionError


def extra_of(last: int) -> Callable[[bytes], Callable[[int], list[np.ndarray]]]:
    """Tables beyond one a pair in the last seatings, by kind of key."""
    return lambda data: lambda kind: Seating(data).extra(kind, last)


def discount_of(once: int, twice: int) -> float:
    """The usual estimate of a discount from how many dishes were seen once and twice."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once else 0.5


def probabilities(wholes: DataFrame, seats: DataFrame, replies: DataFrame, totals: list[Totals]) -> DataFrame:
    """For every bucket the log10 probabilities of its pairs, and how often its words were seen.

    Probabilities are the mean of the predictive ones of the last seatings, each with its own totals.
    """
    arrow = to_arrow(wholes.sparkSession, LOGS)

    def run(key: tuple, part: pa.Table) -> pa.Table:
        bucket = Bucket([data_of(part, WHOLE)])
        (words, *parent), (mass, *tables) = replies_in(part)
        more = bucket.count > 1
        own = Seating(data_of(part, SEATS)).tables if more.any() else [0] * len(totals)
        found, mean = (bucket.count == 1).astype(np.int64), np.zeros(len(bucket.count))
        for k, total in enumerate(totals):
            found[more] = own[k]
            above = above_of(parent[2 * k], parent[2 * k + 1], total)[bucket.word]
            back_off = (STRENGTH + total.discount * tables[k][bucket.context]) * above
            mean += (bucket.count - total.discount * found + back_off) / (STRENGTH + mass[bucket.context])
        row = key[0].as_py(), pressed(np.log10(mean / len(totals)).astype("<f4")), pressed(words.astype("<u8"))
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

    rows = replies.select("shard", "bucket", "what", "data")
    rows = rows.unionByName(as_rows(seats, "seats", SEATS)).unionByName(as_rows(wholes, "whole", WHOLE))
    return rows.groupBy("bucket").applyInArrow(run, LOGS)


def answers(questions: DataFrame, found: DataFrame) -> DataFrame:
    """For every block and bucket the log10 probabilities of pairs, and the counts of words."""
    schema = "block long, bucket int, logs binary, counts binary"
    arrow = to_arrow(questions.sparkSession, schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                logs, counts = opened(row["logs"])[0], opened(row["counts"])[0]
                if row["link"]:
                    word, pair = opened(row["link"])
                    logs, counts = logs[pair], counts[word]
                places = [opened(x) for x in row["places"]]
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["blocks"], pa.int64()),
                        pa.array([row["bucket"]] * n, pa.int32()),
                        pa.array([pressed(logs[pair]) for _, pair in places], pa.binary()),
                        pa.array([pressed(counts[word]) for word, _ in places], pa.binary()),
                    ],
                    schema=arrow,
                )

    return questions.join(found, "bucket").mapInArrow(run, schema)


def learned(docs: DataFrame, text: str, doc_id: str, hot_bytes: int) -> tuple[str, str, str, int, int]:
    """Folders of what blocks keep, of questions and of what buckets answer; trained tokens, and distinct ones.

    Every step is written, and what it was made of goes: the disk holds one form of the pairs and a slice of the next.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(present(text)))).first()[0] or 0
    folder = counted(docs, text, doc_id, max(16, -(-size // BUCKET)))
    whole_path, question_path = in_buckets(spark, folder, hot_bytes)
    wholes = spark.read.schema(WHOLES).parquet(whole_path)
    shards = max(8, -(-size // SHARD))
    static = shard_totals(wholes, shards)
    n_words, word_once, word_twice, n_train = (
        x or 0 for x in static.agg(*(F.sum(n) for n in ("words", "once", "twice", "customers"))).first()
    )
    once, twice = (x or 0 for x in wholes.agg(F.sum("once"), F.sum("twice")).first())
    totals = Totals(0, n_words, n_words, discount_of(once, twice), discount_of(word_once, word_twice))
    seat_path, totals, passes = settled(static, wholes, totals, shards)
    seats = spark.read.schema(SEATINGS).parquet(seat_path)
    messages = sent_out(seats, "seats", extra_of(SAMPLES), ADDS, shards).unionByName(
        sent_out(wholes, "whole", lambda data: Bucket([data]).keys, ASKS, shards)
    )
    replies, reply_path = exchanged(static, messages, totals, SAMPLES, passes)
    sums = sums_of(replies, totals, SAMPLES)
    log_path = scratch_path(spark, "logs")
    for k in range(SLICES):
        mine = (x.where(slice_of("bucket") == k) for x in (seats, replies.where("bucket >= 0")))
        probabilities(wholes.where(F.col("slice") == k), *mine, sums).write.parquet(f"{log_path}/slice={k}")
        delete_path(spark, f"{whole_path}/slice={k}")
        wholes = spark.read.schema(WHOLES).parquet(whole_path)
    delete_path(spark, seat_path)
    delete_path(spark, reply_path)
    return folder, question_path, log_path, n_train, n_words


def scored(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", hot_bytes: int = HOT_BUCKET
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Null texts are empty and have the end alone. Equal rows are trained on and scored each. Without any
    training token all probabilities are those of the base. Empty input gives no rows.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        folder, question_path, log_path, n_train, n_words = learned(docs, text, doc_id, hot_bytes)
    uses = stored(spark, folder, USES)
    questions = spark.read.schema(QUESTIONS).parquet(question_path).drop("slice")
    logs = spark.read.schema(LOGS).parquet(log_path).drop("slice")
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    arrow = to_arrow(spark, schema)
    per_token = float(np.log10(n_train + n_words + 1))

    def add_up(key: tuple, block: pa.Table, found: pa.Table) -> pa.Table:
        entries, doc, times, pairs_of_word = opened(block.column("data")[0].as_py())
        numbers, known, held, lengths = opened(block.column("about")[0].as_py())
        found = found.sort_by("bucket")
        logs = np.concatenate([opened(x)[0] for x in found.column("logs").to_pylist()])
        counts = np.concatenate([opened(x)[0] for x in found.column("counts").to_pylist()])
        count = np.repeat(np.repeat(counts, pairs_of_word), entries).astype(np.float64)
        n = len(numbers)
        total = np.bincount(doc, weights=times * np.repeat(logs.astype(np.float64), entries), minlength=n)
        base = np.bincount(doc, weights=times * np.log10(count + 1), minlength=n) - lengths * per_token
        hits = np.bincount(doc, weights=times * (count > 0), minlength=n).astype(np.int64)
        columns = [
            pa.array(numbers, mask=known == 0),
            pa.array(held > 0),
            pa.array(lengths),
            pa.array(hits),
            pa.array(np.full(n, n_train)),
            pa.array(base),
            pa.array(total),
        ]
        return pa.Table.from_arrays(columns, schema=arrow)

    both = uses.select("block", "data", "about").groupBy("block").cogroup(
        answers(questions, logs).groupBy("block")
    )
    return both.applyInArrow(add_up, schema)


def perplexities(scores: DataFrame) -> DataFrame:
    """Perplexity of the model and of the base, by held_out."""
    per_token = F.sum(F.col("n_tokens"))
    return scores.groupBy("held_out").agg(
        F.pow(F.lit(10.0), -F.sum("score") / per_token).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / per_token).alias("base_perplexity"),
    )
