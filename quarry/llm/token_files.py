"""Token ids in canonical length-limited Huffman files.

1. Texts are encoded by the tokenizers library. White space separates its words,
   so a text is cut at blanks and line feeds (its special tokens have none). Arrow
   finds a batch's distinct pieces, lowers words and parts them from closing marks;
   words met before come from a bounded memo of the Python worker, and the library
   sees each other word or piece.
2. Ranges of (doc_id, text hash) from approximate quantiles number the parts of
   the file; ids are shuffled there once, sorted, and packed into blocks of whole
   documents. The blocks are stored (ids compressed).
3. Global counts (one row per id) give code lengths by package-merge, at most
   ``LIMIT`` bits; lengths alone fix the canonical codes.
4. Each block is written as one bit string with its own documents, counts and the
   bit offset of every ``STRIDE``-th id, so blocks decode alone, in any order,
   and inside a block all checkpoints decode side by side through one table
   lookup of ``LIMIT`` bits per id.
5. Reading back decodes the files; the offset of a document is the running sum
   over parts (one row each), over the blocks of its part, and inside its block.

The container is Parquet, so that any store Spark writes to will do and a task
that is run again leaves no half-written block; the payload is the bit string.

Defined results: a null or empty text is its end id alone; rows with equal ids
follow each other by text hash, null ids come first; an empty table gives an
empty file; a code with one id has length 1; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import staged, text_of

VOCABULARY = "word_bpe_49k.json"
END = 2
LIMIT = 16
STRIDE = 128
BLOCK = 1 << 18
MEMO = 250_000
PIECE = 1 << 23  # bytes of text that are cut and encoded at once
#: ASCII symbols that close a word; the library parts letters from them. An apostrophe may open a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BEFORE_MARKS = "^.*[^" + re.escape(_MARKS) + "]"
#: Letters that the library's NFC keeps, with one lower case in any context.
_WORD = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e]+$"
_SIMPLE = re.compile("[\x21-\x7e\xa1-\u012f\u0132-\u017f]+")


def _byte_level() -> list[str]:
    """Character of each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes take the characters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_BYTE_LEVEL = _byte_level()


class WordIds(dict):
    """Memo word or other piece without blanks -> its ids (16 bits each)."""

    def __init__(self, path: str, memo: int = MEMO):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memo, self.old = memo, {}
        self[""] = b""
        self.model = self.library.model
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces that aren't known. Lower-case letters are one word that the library's
        normalisation keeps, so its model takes them as they are, in byte-level characters."""
        rest, tokens = [], self.model.tokenize
        for p in pieces:
            plain = p.isascii()
            if p.isalpha() and p.islower() and (plain or _SIMPLE.fullmatch(p)):
                found = tokens(p if plain else "".join(map(_BYTE_LEVEL.__getitem__, p.encode())))
                self[p] = array("H", [t.id for t in found]).tobytes()
            else:
                rest.append(p)
        for p, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[p] = array("H", e.ids).tobytes()

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of each of the distinct ``pieces``; the memo keeps them."""
        found, old = list(map(self.get, pieces)), self.old
        new = [p for p, x in zip(pieces, found, strict=True) if x is None]
        if not new:
            return found
        learn = []
        for p, x in zip(new, map(old.get, new), strict=True):
            if x is None:
                learn.append(p)
            else:
                self[p] = x
        if learn:
            self._learn(learn)
        return [self[p] if x is None else x for p, x in zip(pieces, found, strict=True)]

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces as bytes. A word with closing marks is its lower-case letters and
        then the marks, which Arrow takes apart, so the memo is asked once a word and not once a form."""
        bare = pc.utf8_rtrim(pieces, characters=_MARKS)
        plain = pc.match_substring_regex(bare, _WORD)
        words = pc.if_else(plain, pc.utf8_lower(bare), pieces).dictionary_encode()
        found = self._looked_up(words)
        at = pc.indices_nonzero(pc.and_(plain, pc.less(pc.binary_length(bare), pc.binary_length(pieces))))
        if not len(at):
            return found
        tails = pc.replace_substring_regex(pieces.take(at), _BEFORE_MARKS, "").dictionary_encode()
        whole = pc.binary_join_element_wise(found.take(at), self._looked_up(tails), b"")
        order = np.arange(len(pieces))
        order[at.to_numpy()] = len(pieces) + np.arange(len(at))
        return pa.concat_arrays([found, whole]).take(pa.array(order))

    def _looked_up(self, coded: pa.DictionaryArray) -> pa.Array:
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return pa.array(known, pa.binary()).take(coded.indices)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each text has. Texts are cut and their distinct
        pieces found by Arrow."""
        if len(self) > self.memo:
            self.old = {}
            self.old = dict(self)
            self.clear()
            self[""] = b""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        raw = self._ids_of(coded.dictionary)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy() // 2)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(pa.uint16(), int(ends[-1]), [None, raw.buffers()[2]]))
        ids = lists.take(coded.indices)
        total = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(), dtype=np.int64)])
        edge = cut.offsets.to_numpy()
        return ids.flatten().to_numpy(), total[edge[1:] - edge[0]] - total[edge[:-1] - edge[0]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, 16 bits each."""
        ids, n = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), 2 * np.cumsum(n)
        return [raw[e - 2 * k:e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``PIECE`` bytes (a longer text by itself)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    start = 0
    for end in (np.flatnonzero(np.diff(size // PIECE, append=-1)) + 1).tolist():
        yield texts[start:end]
        start = end


def sort_key() -> Column:
    """Grows with (doc_id, text hash); as a double it only has to be monotonic."""
    low = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 44)
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 40))).cast("double") * F.lit(float(1 << 20)) + low


def part_bounds(docs: DataFrame, parts: int) -> list[float]:
    """Ascending upper bounds of all parts but the last; the sort key alone is read."""
    at = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(sort_key(), at, 20 * parts).alias("q")).first()["q"] if at else None
    return sorted(set(found or []))


def blocks_of(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """Stored blocks (part, block, doc_id, n, ids) of the ids of ``docs``, in order."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"),
                       text_of().alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = part_bounds(rows, parts)
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<double>"), lambda b: b < F.col("_k")))

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, press = word_ids(path), zstandard.ZstdCompressor(level=1)
        last = np.array([end], np.uint16).tobytes()
        for b in batches:
            n, out = [], []
            for group in _groups(b.column(3)):
                ids, size = own.encode_column(group)
                raw, at = ids.tobytes(), 0
                for k in size.tolist():
                    n.append(k + 1)
                    out.append(press.compress(raw[at:at + 2 * k] + last))
                    at += 2 * k
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                ["part", "doc_id", "h", "n", "ids"])

    found = (rows.withColumn("_k", sort_key()).select(part.alias("part"), "doc_id", "h", "text")
             .mapInArrow(tokenise, "part int, doc_id long, h long, n long, ids binary"))
    dealt = (found.repartitionById(len(bounds) + 1, F.col("part"))
             .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "h"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, open_ = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        now, block, size = None, 0, 0
        ids: list[bytes] = []
        who: list[int | None] = []
        n: list[int] = []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([block], pa.int32()), pa.array([who], pa.list_(pa.int64())),
                 pa.array([n], pa.list_(pa.int64())), pa.array([press.compress(b"".join(ids))], pa.binary())],
                ["part", "block", "doc_id", "n", "ids"])

        for b in batches:
            for p, d, k, x in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if ids and (p != now or size >= BLOCK):
                    yield done()
                    block, size, ids, who, n = (block + 1 if p == now else 0), 0, [], [], []
                now = p
                ids.append(open_.decompress(x))
                who.append(d)
                n.append(k)
                size += k
        if ids:
            yield done()

    return staged(dealt.mapInArrow(pack, "part int, block int, doc_id array<long>, n array<long>, ids binary"),
                  "token_blocks")


def id_counts(blocks: DataFrame) -> np.ndarray:
    """Occurrences of every id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, total = zstandard.ZstdDecompressor(), np.zeros(1 << 16, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(open_.decompress(x), np.uint16), minlength=1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "c"])

    out = np.zeros(1 << 16, np.int64)
    # as many rows as ids in use
    for r in blocks.select("ids").mapInArrow(run, "id long, c long").groupBy("id").agg(F.sum("c").alias("c")).collect():
        out[r["id"]] = r["c"]
    return out


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0.

    Level by level the cheapest items are the leaves merged with pairs of the
    level below. What the solution takes of a level is a prefix of it, so the
    leaves it takes are a prefix of the leaves: each such leaf gets one bit more.
    """
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    for level in range(limit):
        if level:
            even = items[:len(items) // 2 * 2]
            both = np.concatenate([leaves, even[0::2] + even[1::2]])
            at = np.argsort(both, kind="stable")
            items = both[at]
            levels.append(at < len(leaves))
        else:
            levels.append(np.ones(len(leaves), bool))
    take, bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        mine = int(is_leaf[:take].sum())
        bits[:mine] += 1
        take = 2 * (take - mine)
    out[order] = bits
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    code = last = 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[lengths[order] > 0].tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bit string (16-bit cells, most significant bit first) and checkpoint bit offsets."""
    size = lengths[ids]
    ends = np.cumsum(size, dtype=np.int64)
    starts = ends - size
    cell = starts >> 4
    left = codes << (LIMIT - lengths.astype(np.uint32))  # aligned to the cell's first bit
    wide = (left[ids] << np.uint32(16)) >> (starts & 15).astype(np.uint32)  # over two cells
    n = (int(ends[-1]) + 15 >> 4) + 1 if len(ids) else 1
    # the codes' bits are disjoint: sums are ors
    cells = np.bincount(cell, wide >> np.uint32(16), n)
    cells[1:] += np.bincount(cell, wide & np.uint32(0xFFFF), n)[:-1]
    return cells.astype(">u2").tobytes(), starts[::STRIDE].astype(np.uint64)


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each LIMIT-bit prefix: the id it starts with and the length of its code."""
    codes = canonical_codes(lengths).astype(np.int64)
    ids, bits = np.zeros(1 << LIMIT, np.uint16), np.zeros(1 << LIMIT, np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]  # canonical codes fill the table in this order
    spans = 1 << (LIMIT - lengths[order].astype(np.int64))
    total = int(spans.sum())
    ids[:total], bits[:total] = np.repeat(order, spans), np.repeat(lengths[order].astype(np.int64), spans)
    if len(order) and int(codes[order[0]]):
        raise ValueError("the codes aren't canonical")
    return ids, bits


def unpack_bits(payload: bytes, checkpoints: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ``n`` ids of a block: all checkpoints advance together, one table lookup an id."""
    ids, bits = table
    cells = np.concatenate([np.frombuffer(payload, ">u2"), [0, 0]]).astype(np.int64)
    pairs = cells[:-1] << 16 | cells[1:]
    lanes = len(checkpoints)
    out = np.zeros((STRIDE, lanes), np.uint16)
    at = checkpoints.astype(np.int64)
    for step in range(min(STRIDE, n)):
        if step and (live := lanes if step < n - (lanes - 1) * STRIDE else lanes - 1) < len(at):
            at = at[:live]  # the last checkpoint has fewer ids
        word = pairs[at >> 4] >> (16 - (at & 15)) & 0xFFFF
        out[step, :len(at)] = ids[word]
        at = at + bits[word]
    return out.T.reshape(-1)[:n] if lanes else np.zeros(0, np.uint16)


def write_files(docs: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(header with the code lengths, blocks) as stored files."""
    blocks = blocks_of(docs, vocabulary or public_tokenizers.path(VOCABULARY))
    lengths = code_lengths(id_counts(blocks))
    codes = canonical_codes(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for b in batches:
            packed = [pack_bits(np.frombuffer(open_.decompress(x), np.uint16), codes, lengths)
                      for x in b.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([c.astype("<u4").tobytes() for _, c in packed], pa.binary()),
                 pa.array([p for p, _ in packed], pa.binary())],
                ["part", "block", "doc_id", "n", "checkpoints", "payload"])

    out = blocks.sortWithinPartitions("part", "block").mapInArrow(
        run, "part int, block int, doc_id array<long>, n array<long>, checkpoints binary, payload binary")
    spark = docs.sparkSession
    header = spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1)
    return staged(header, "token_header"), staged(out, "token_file")


def read_files(header: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (16-bit little-endian binary) decoded from the files."""
    return _placed(blocks, _decoded(header, blocks, lambda ids: ids.astype("<u2").tobytes(), pa.binary(), "ids binary"))


def _decoded(header: DataFrame, blocks: DataFrame, make, kind: pa.DataType, column: str) -> DataFrame:
    """(part, block, doc_id, ahead, n_tokens, column): one row per document; ``ahead``: ids before it in its block."""
    lengths = np.frombuffer(bytes(header.first()["lengths"]), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for b in batches:
            for part, block, who, n, marks, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                size = np.array(n, np.int64)
                ends = np.cumsum(size)
                ids = unpack_bits(payload, np.frombuffer(marks, "<u4"), int(ends[-1]), table)
                made = [make(ids[a:e]) for a, e in zip((ends - size).tolist(), ends.tolist(), strict=True)]
                k = len(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array([block] * k, pa.int32()), pa.array(who, pa.int64()),
                     pa.array(ends - size), pa.array(size), pa.array(made, kind)],
                    ["part", "block", "doc_id", "ahead", "n_tokens", column.split()[0]])

    return blocks.mapInArrow(run, f"part int, block int, doc_id long, ahead long, n_tokens long, {column}")


def _placed(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before, from the stored counts."""
    size = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = blocks.select("part", "block", size.alias("size"))
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("part", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("in_part"))
    # one row per part of the file: as many as shuffle partitions
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(over), F.lit(0)).alias("of_part"))
    at = inside.join(parts, "part")
    return (docs.join(at, ["part", "block"])
            .withColumn("start", F.col("of_part") + F.col("in_part") + F.col("ahead"))
            .drop("part", "block", "of_part", "in_part", "ahead"))


def token_files(docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the written files."""
    header, blocks = write_files(docs)
    rows = _decoded(header, blocks, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")
    return _placed(blocks, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
