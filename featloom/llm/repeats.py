"""Byte strings that stand in more than one place, found by suffix arrays of the places that matter.

A string of ``LENGTH`` bytes has one anchor: the smallest of the hashes of its substrings of ``CORE`` bytes, the
first of equal ones. Equal strings have equal anchors at equal offsets, so a string can only repeat
where its anchor does. Neighbouring strings of one anchor make up a piece, and pieces are settled
by the groups of their anchors:

- pieces that are equal as a whole repeat as a whole; they are counted by digest and never moved;
- the others come with their bytes to the task of their anchor, and a suffix array of the
  group tells how far each agrees with any other;
- a group of more than ``LIMIT`` different pieces is dealt anew by longer common parts, with half as many
  strings in each piece, until groups are small or pieces are single strings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import (
    Batches,
    free_name,
    group_starts,
    map_batches,
    present,
    ship,
    signed,
    text_bytes,
    to_arrow,
    whole_groups,
)
from featloom.llm.suffixes import common_prefixes, suffix_array
from featloom.session import checkpointed

LENGTH = 400
CORE = 200
SPAN = LENGTH - CORE + 1
"""Offsets that an anchor can have in a string."""
BLOCK = 1 << 18
"""Strings of a text that are looked at in one go."""
PLACE_BITS = 20
LIMIT = 2048
PORTION = 2048
"""Pieces whose groups share a suffix array."""

WORDS = 50
"""Words of a passage that is cut out of texts where it stands elsewhere, too."""
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

ROW = ["doc_id", "text_hash"]
PIECE = "doc_id long, text_hash long, anchor long, digest long, first int, n int, offset int"
SPANS = "doc_id long, text_hash long, begin int, stop int"


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, np.uint64(base % (1 << 64)))
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
_UP = powers(_BASE, BLOCK + LENGTH)
_DOWN = powers(pow(_BASE, -1, 1 << 64), BLOCK + LENGTH)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers with all bits depending on all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def core_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every substring of ``CORE`` bytes."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(data.astype(np.uint64) + np.uint64(1)) * _UP[:n], out=total[1:])
    return mixed((total[CORE:] - total[:-CORE]) * _DOWN[: n - CORE + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    pad = np.full(-len(values) % width, np.uint64(2**64 - 1))
    table = np.concatenate([values, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(table, 1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def pieces_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """anchor, first string, number of strings, the anchor's offset, and digest of each piece."""
    found: list[tuple] = []
    digests: list[int] = []
    for base in range(0, len(text) - LENGTH + 1, BLOCK):
        part = text[base : base + BLOCK + LENGTH - 1]
        if len(part) < LENGTH:
            break
        hashes = core_hashes(np.frombuffer(part, np.uint8))
        low = np.uint64((1 << PLACE_BITS) - 1)
        placed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        where = (sliding_least(placed, SPAN) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        n = np.diff(np.append(first, len(where)))
        anchor = where[first]
        found.append((hashes[anchor].view(np.int64), first + base, n, anchor - first))
        ends = (first + n + LENGTH - 1).tolist()
        digest = xxhash.xxh3_64_intdigest
        digests += [signed(digest(part[a:b])) for a, b in zip(first.tolist(), ends, strict=True)]
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, []
    return *(np.concatenate(x) for x in zip(*found, strict=True)), digests


def all_pieces(rows: DataFrame, words: int | None = None) -> DataFrame:
    """The pieces of all texts, or of their words' hashes; short texts have none."""
    units = word_units(words)

    def make(batch: pa.RecordBatch) -> dict | None:
        parts, counts = [], []
        for text in text_bytes(batch):
            parts.append(pieces_of(units(text)))
            counts.append(len(parts[-1][4]))
        if not sum(counts):
            return None
        of = np.repeat(np.arange(len(counts)), counts)
        anchor, first, n, offset = (np.concatenate([p[k] for p in parts]) for k in range(4))
        return {
            "doc_id": batch.column("doc_id").take(pa.array(of)),
            "text_hash": batch.column("text_hash").take(pa.array(of)),
            "anchor": anchor,
            "digest": [x for p in parts for x in p[4]],
            "first": first,
            "n": n,
            "offset": offset,
        }

    return map_batches(rows.where(F.octet_length("text") >= shortest(words)), make, PIECE)


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """doc_id, text_hash, begin and stop of stretches that together are all repeated bytes.

    Stretches of a text may overlap. Equal rows repeat one another and have the same stretches.
    """
    return spans_of(keyed(docs, text, doc_id), limit)


def spans_of(rows: DataFrame, limit: int = LIMIT, words: int | None = None) -> DataFrame:
    """The repeated stretches of ``rows`` (doc_id, text_hash, text), in bytes of the texts or of their words' hashes."""
    pieces = checkpointed(all_pieces(rows, words))
    counts = checkpointed(pieces.groupBy("anchor", "digest").agg(F.count("*").alias("n_equal")))
    groups = counts.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n_equal").alias("least"))
    groups = groups.where((F.col("kinds") > 1) | (F.col("least") > 1))
    # where nothing stands alone, every piece is settled by its equals
    open_ = (F.col("kinds") > 1) & (F.col("least") == 1)
    told = counts.join(groups, "anchor").select("anchor", "digest", "n_equal", open_.alias("open"))
    found = checkpointed(pieces.join(told.where("open or n_equal > 1"), ["anchor", "digest"]))
    spans = found.where("n_equal > 1").select(*ROW, *stretch())
    kinds = found.where("open").groupBy("anchor", "digest").agg(
        F.max("n_equal").alias("n_equal"), F.min(F.struct(*ROW, "first", "n", "offset")).alias("at")
    )
    kinds = kinds.select("anchor", "digest", "n_equal", "at.*")
    whole = F.lit(0).alias("low"), F.lit(SPAN).alias("width"), F.lit(0).cast("long").alias("part")
    loose = checkpointed(with_bytes(rows, kinds, words).select("*", *whole))
    closed = []
    while True:
        keys = ["anchor", "low", "width", "part"]
        large = loose.groupBy(*keys).agg(F.count("*").alias("size")).where(F.col("size") > limit)
        if large.isEmpty():
            closed.append(loose)
            break
        large = checkpointed(large.select(*keys))
        closed.append(loose.join(large, keys, "left_anti"))
        halves = checkpointed(halved(loose.join(large, keys)))
        same = [*keys, "digest"]
        kinds = halves.groupBy(*same).agg(F.sum("n_equal").alias("total"))
        halves = halves.drop("total").join(kinds, same)
        spans = spans.unionByName(halves.where("total > 1 and n_equal = 1").select(*ROW, *stretch()))
        names = [c for c in loose.columns if c not in same and c != "n_equal"]
        kept = halves.groupBy(*same).agg(
            F.max("total").alias("n_equal"), F.min(F.struct(*names)).alias("at")
        )
        alone = kept.groupBy(*keys).agg(F.count("*").alias("size"), F.min("n_equal").alias("least"))
        alone = alone.where("size > 1 and least = 1").select(*keys)
        loose = checkpointed(
            kept.join(alone, keys).select(*same, "n_equal", "at.*").select(*loose.columns)
        )
    for part in closed:
        spans = spans.unionByName(agreeing(part))
    return spans


def stretch() -> tuple:
    """The bytes that the strings of a piece cover."""
    return (
        F.col("first").cast("int").alias("begin"),
        (F.col("first") + F.col("n") + LENGTH - 1).cast("int").alias("stop"),
    )


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text_hash and text; null texts are empty."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(present(text)).alias("text_hash"),
        present(text).alias("text"),
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Rows of one document; its id may be null."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def with_bytes(rows: DataFrame, kinds: DataFrame, words: int | None = None) -> DataFrame:
    """Pieces with their bytes, for which the texts that have any come to their rows."""
    units = word_units(words)
    listed = kinds.groupBy(*ROW).agg(
        F.collect_list(F.struct("anchor", "digest", "n_equal", "first", "n", "offset")).alias("pieces")
    )
    once = rows.where(F.octet_length("text") >= shortest(words))
    both = once.join(listed, same_row(once, listed)).select(
        listed["doc_id"], listed["text_hash"], "text", "pieces"
    )

    def make(batch: pa.RecordBatch) -> dict:
        lists = batch.column("pieces")
        inner = lists.flatten()
        counts = lists.value_lengths().to_numpy()
        of = pa.array(np.repeat(np.arange(len(counts)), counts))
        names = ("anchor", "digest", "n_equal", "first", "n", "offset")
        out = dict(zip(names, (inner.field(n) for n in names), strict=True))
        texts = np.repeat(np.arange(len(counts)), counts).tolist()
        held, first, n = [units(text) for text in text_bytes(batch)], out["first"].to_pylist(), out["n"].to_pylist()
        out["bytes"] = [
            held[t][a : a + k + LENGTH - 1] for t, a, k in zip(texts, first, n, strict=True)
        ]
        return out | {c: batch.column(c).take(of) for c in ROW}

    schema = f"{PIECE}, n_equal long, bytes binary"
    # equal rows have equal pieces, of which one is enough
    return map_batches(both, make, schema).dropDuplicates([*ROW, "first", "digest"])


def halved(pieces: DataFrame) -> DataFrame:
    """The two halves of every piece, dealt by the bytes that all strings of a half have in common."""

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in batch.schema.names}
        for row in batch.to_pylist():
            step = row["width"] // 2
            anchor, data = row["first"] + row["offset"], row["bytes"]
            for low, width in ((row["low"], step), (row["low"] + step, row["width"] - step)):
                # strings whose anchor stands low ... low + width - 1 bytes after their start
                begin = max(row["first"], anchor - low - width + 1)
                end = min(row["first"] + row["n"], anchor - low + 1)
                if begin >= end:
                    continue
                cut = data[begin - row["first"] : end - row["first"] + LENGTH - 1]
                core = data[anchor - low - row["first"] : anchor - low - width + 1 - row["first"] + LENGTH]
                new = row | {
                    "first": begin,
                    "n": end - begin,
                    "offset": anchor - begin,
                    "low": low,
                    "width": width,
                    "part": signed(xxhash.xxh3_64_intdigest(core)),
                    "digest": signed(xxhash.xxh3_64_intdigest(cut)),
                    "bytes": cut,
                }
                for n, v in new.items():
                    out[n].append(v)
        return out

    schema = f"{PIECE}, n_equal long, bytes binary, low int, width int, part long"
    return map_batches(pieces.select(*[c.split()[0] for c in schema.split(", ")]), make, schema)


def agreeing(pieces: DataFrame) -> DataFrame:
    """Stretches of single pieces that agree with another piece of their group."""
    ship(pieces.sparkSession)
    arrow = to_arrow(pieces.sparkSession, SPANS)
    keys = ["anchor", "low", "width", "part"]

    def run(batches: Batches) -> Batches:
        for rows in whole_groups(batches, keys, PORTION):
            found = list(shared_stretches(rows, group_starts(rows, keys)))
            which = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").combine_chunks().take(which),
                    rows.column("text_hash").combine_chunks().take(which),
                    pa.array([x[1] for x in found], pa.int32()),
                    pa.array([x[2] for x in found], pa.int32()),
                ],
                schema=arrow,
            )

    dealt = pieces.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, SPANS)


def shared_stretches(rows: pa.Table, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Row, begin and stop of what single pieces share with others of their group."""
    offset, first = rows.column("offset").to_pylist(), rows.column("first").to_pylist()
    data, alone = rows.column("bytes").to_pylist(), rows.column("n_equal").to_pylist()
    symbols: list[int] = []
    sizes: list[int] = []
    names: dict[tuple, int] = {}
    marks: list[tuple[int, int, int, int]] = []
    for group, (low, high) in enumerate(zip(starts, [*starts[1:], rows.num_rows], strict=True)):
        if high - low < 2:
            continue
        left = [data[k][: offset[k]][::-1] for k in range(low, high)]
        right = [data[k][offset[k] :] for k in range(low, high)]
        before, after = parting_points(left), parting_points(right)
        for k in range(low, high):
            cuts = [c for c in before if c < offset[k]] + [offset[k]] * (offset[k] > 0)
            # from the farthest to the anchor, and on to the end
            for j in range(len(cuts) - 1, -1, -1):
                near = cuts[j - 1] if j else 0
                marks.append((len(symbols), k, near, cuts[j]))
                key = (group, -cuts[j], -near, data[k][offset[k] - cuts[j] : offset[k] - near])
                symbols.append(names.setdefault(key, len(names) + 2))
                sizes.append(cuts[j] - near)
            marks.append((len(symbols), k, -1, 0))
            at = 0
            for cut in [c for c in after if c < len(right[k - low])] + [len(right[k - low])]:
                if cut > at:
                    key = (group, at, cut, right[k - low][at:cut])
                    symbols.append(names.setdefault(key, len(names) + 2))
                    sizes.append(cut - at)
                    at = cut
            symbols.append(1)
            sizes.append(0)
    if not symbols:
        return
    symbols.append(0)
    sizes.append(0)
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order, 1)
    ends = np.cumsum([0, *sizes])
    best = [0] * len(symbols)
    for place in range(1, len(order)):
        n = shared[place]
        best[order[place]] = max(best[order[place]], n)
        best[order[place - 1]] = max(best[order[place - 1]], n)
    for at, k, near, far in marks:
        if alone[k] > 1 or not best[at]:
            continue
        agreed = int(ends[at + best[at]] - ends[at])
        # a string that starts o bytes before the anchor needs LENGTH - o bytes from it on
        least = max(near + 1, LENGTH - (agreed - far))
        if least <= far:
            anchor = first[k] + offset[k]
            yield k, anchor - far, anchor - least + LENGTH


def parting_points(strings: list[bytes]) -> list[int]:
    """The lengths at which two neighbours in sorted order part: any two strings part at one of them."""
    ordered = sorted(strings)
    return sorted({agreement(a, b) for a, b in zip(ordered, ordered[1:], strict=False)} - {0})


def agreement(a: bytes, b: bytes) -> int:
    """How many bytes two strings have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax())


def hash_width(words: int) -> int:
    """Bytes that stand for a word, so that ``words`` of them are one string."""
    if LENGTH % words or not 4 <= LENGTH // words <= 16:
        raise ValueError(f"a passage has 25, 40, 50, 80 or 100 words, not {words}")
    return LENGTH // words


def word_units(words: int | None) -> Callable[[bytes], bytes]:
    """What turns a text into bytes to look for repeats in: itself, or with ``words`` the hashes of its words.

    Strings of LENGTH bytes are passages of ``words`` words then, whatever white space is between them.
    A repeated stretch can begin or end inside a hash only by a chance agreement of some of its bytes.
    """
    if words is None:
        return bytes
    width = hash_width(words)
    if width == 8:
        return lambda text: b"".join(map(xxhash.xxh3_64_digest, text.split()))
    return lambda text: b"".join([xxhash.xxh3_128_digest(word)[:width] for word in text.split()])


def shortest(words: int | None) -> int:
    """Bytes that a text has at least if it can hold a repeat."""
    return LENGTH if words is None else 2 * words - 1


def with_spans(docs: DataFrame, text: str, doc_id: str, words: int | None = None) -> tuple[DataFrame, str]:
    """``docs`` with an array of their repeated stretches, null if there is none, and its name.

    The stretches are bytes of the texts, or with ``words`` bytes of their words' hashes.
    """
    if words is None:
        found = repeated_spans(docs, text, doc_id)
    else:
        found = spans_of(keyed(docs, text, doc_id), words=words)
    spans = found.groupBy(*ROW).agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))
    name = free_name(docs, "_spans")
    key = F.struct(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(0)),
        F.col(doc_id).isNull(),
        F.xxhash64(present(text)),
    )
    row = free_name(docs, "_row")
    own = spans.select(
        F.struct(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text_hash").alias(row),
        F.col("spans").alias(name),
    )
    return docs.withColumn(row, key).join(own, row, "left").drop(row), name


def merged(begin: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Stretches joined where they overlap or touch."""
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], begin[1:] > stop[:-1]])
    last = np.concatenate([new[1:], [True]])
    return list(zip(begin[new].tolist(), stop[last].tolist(), strict=True))


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the stretches."""
    if not spans:
        return text
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def kept_text(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the stretches and without the rest of characters that they go through."""
    whole = []
    for begin, stop in spans:
        while begin > 0 and begin < len(text) and text[begin] & 0xC0 == 0x80:
            begin -= 1
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop += 1
        if whole and begin < whole[-1][1]:
            begin = whole.pop()[0]
        whole.append((begin, stop))
    return kept_bytes(text, whole).decode()


def kept_words(text: bytes, spans: list[tuple[int, int]], width: int) -> bytes:
    """The text without the words whose hashes lie in the stretches, and the white space after them."""
    starts = [m.start() for m in WORD.finditer(text)] + [len(text)]
    cuts = [(-(-begin // width), stop // width) for begin, stop in spans]
    return kept_bytes(text, [(starts[a], starts[b]) for a, b in cuts if a < b])


def stretches(batch: pa.RecordBatch, name: str) -> Iterator[list[tuple[int, int]]]:
    """The merged stretches of every row."""
    column = batch.column(name)
    inner = column.flatten()
    begin, stop = inner.field("begin").to_numpy(), inner.field("stop").to_numpy()
    at = 0
    for n in column.value_lengths().fill_null(0).to_pylist():
        yield merged(begin[at : at + n], stop[at : at + n])
        at += n


def repeat_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept and text of every row; null texts are empty.

    ``text`` is what is left, without the rest of characters that a cut goes through; ``kept_sha256`` and
    ``n_kept`` count all bytes that are left.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found, name = with_spans(rows, "text", "doc_id")

    def make(batch: pa.RecordBatch) -> dict:
        out: dict = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "text")}
        for data, spans in zip(text_bytes(batch), stretches(batch, name), strict=True):
            out["n_bytes"].append(len(data))
            out["n_removed"].append(sum(b - a for a, b in spans))
            out["n_spans"].append(len(spans))
            kept = kept_bytes(data, spans)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["n_kept"].append(len(kept))
            out["text"].append(kept_text(data, spans))
        return out | {"doc_id": batch.column("doc_id")}

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, text string"
    )
    return map_batches(found, make, schema)


def cut_repeats(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    n_chars: str = "n_chars",
    words: int = WORDS,
) -> DataFrame:
    """``docs`` without the passages of ``words`` words and more that stand elsewhere, too.

    White space between words does not matter; other differences do. Every copy is cut, the first one as
    well, with the white space after it; n_chars, if there, is counted anew. A text without repeats stays as
    it is, null included, and a text that is all repeats becomes empty. Equal rows repeat one another. An
    empty table stays empty, and further columns, whatever their names, stay as they are.
    """
    found, name = with_spans(docs, text, doc_id, words)
    width = hash_width(words)
    position = found.columns.index(text)
    names = docs.columns

    def cut(batch: pa.RecordBatch) -> list[str | None]:
        texts = batch.column(position)
        out = []
        for k, spans in enumerate(stretches(batch, name)):
            value = texts[k].as_py()
            out.append(kept_words(value.encode(), spans, width).decode() if spans else value)
        return out

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = [batch.column(n) for n in range(len(names))]
            columns[position] = pa.array(cut(batch), batch.schema.field(position).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ship(docs.sparkSession)
    result = found.select(*[F.col(f"`{n}`") for n in names], name).mapInArrow(run, docs.schema)
    if n_chars in docs.columns:
        counted = F.length(text).cast(docs.schema[n_chars].dataType)
        same = F.col(text).isNull()
        result = result.withColumn(n_chars, F.when(same, F.col(n_chars)).otherwise(counted))
    return result
