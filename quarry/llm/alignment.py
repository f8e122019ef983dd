"""Cross-tokenizer alignment on Arrow columns.

1. Both tokenizers encode the texts. A text is cut before a single blank or line
   feed between two non-blank characters: neither tokenizer joins anything across
   such a place (checked against B's pieces when it is loaded), so chunks met before
   come from a bounded memo of the Python worker.
2. A group of whole documents is aligned at once: the lists of ids are flattened,
   parent indices name the document of each token, and the cumulative byte lengths
   less those before the document are the tokens' ends. A full outer hash join of A's
   and B's ends on (document, end) gives one row for each end in use. Byte ranges of
   tokens that overlap do so in one piece that ends at such a place, so a row is a
   link, and the A and B tokens of a link are the next ones to end (null filled
   backwards). Rows that both have cut the groups.
3. Links are stored with their document. ``group_by`` counts the id pairs of a task,
   Spark sums the counts of all tasks.
4. The counts of all pairs, and whether a pair is its B id's most frequent, go back
   to the links: in slices of at most ``MOST_PAIRS`` pairs that are broadcast one
   after the other, so that a broadcast never grows with the data. A document's
   sums grow slice by slice.

Defined results: a null or empty text, and one whose joined token bytes of A or B
aren't those of a space and the text, has no tokens: zeros and ''. Repeated rows are
aligned, and count, each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged, text_of

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MEMO = 300_000
#: Characters that are aligned at once (a longer text by itself), links that are looked up at once.
GROUP = 1 << 20
LINKS = 1 << 20
#: Distinct id pairs whose counts are broadcast at once, and that a task holds.
MOST_PAIRS = 1 << 21
_SPACE = "▁"
_DOUBLE = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_MARKS = (",", ".")
_LETTER_MARK = re.compile(r"[^\W\d_][.,]")
_B_ID = 1 << 16  # a pair is a * _B_ID + b


def _byte_level() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable Latin-1 stands for itself,
    the other bytes take the characters from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the memo of chunks."""

    def __init__(self, path_a: str, path_b: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        to_byte = _byte_level()
        names = self.a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = bytes(map(to_byte.__getitem__, name)) if all(c in to_byte for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        if max(len(self.bytes_a), len(self.bytes_b)) > _B_ID:
            raise ValueError("ids of more than 16 bits")
        # no piece reaches over a line feed, or over a blank after something else
        self.may_cut = not any("\n" in p or _SPACE in p.lstrip(_SPACE) for p in pieces)
        self.size_a, self.size_b = (pa.array([len(x) for x in t], pa.int64()) for t in (self.bytes_a, self.bytes_b))
        self.first_a, self.first_b = (np.array([t[0] if t else 0 for t in x], np.uint8) for x in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = (pa.array([str(i) for i in range(len(t))]) for t in (self.bytes_a, self.bytes_b))
        # no piece of B holds a letter and a mark after it; A's pattern parts them
        self.parts_marks = not any(_LETTER_MARK.search(p) for p in pieces)
        self.marks_a = {m: array("H", self.a.encode(m, add_special_tokens=False).ids).tobytes() for m in _MARKS}
        self.marks_b = {m: array("H", [self.b.piece_to_id(m)]).tobytes() for m in _MARKS}
        self.memo = memo
        self.forget()

    def chunks(self, text: str) -> list[str]:
        """Pieces of a space and ``text``. The blank before a piece that starts with neither
        blank nor line feed is left out."""
        if not self.may_cut:
            return [" " + text]
        first, *rest = _CUT.split(" " + text)
        return [first if text[0].isspace() else first[1:], *(p if p[0] == "\n" else p[1:] for p in rest)]

    def cut(self, texts: list[str]) -> pa.ListArray:
        """The chunks of each text; texts with plain blanks are cut by Arrow. An empty text has the chunk ''."""
        odd = [bool(t) and (not self.may_cut or t[0].isspace() or t[-1].isspace() or _DOUBLE.search(t) is not None) for t in texts]
        plain = pa.array([t for t, o in zip(texts, odd, strict=True) if not o], pa.string())
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        if not any(odd):
            return lists
        rest = pa.array([self.chunks(t) for t, o in zip(texts, odd, strict=True) if o], pa.list_(pa.string()))
        place = np.empty(len(texts), np.int64)
        place[np.argsort(np.array(odd), kind="stable")] = np.arange(len(texts))
        return pa.concat_arrays([lists, rest]).take(pa.array(place))

    def _run(self, chunks: list[str], blank: str, each: int) -> list[str]:
        """Learn chunks that follow one another after a ``blank``, ``each`` in one text to B; what's left over.

        A token that starts with the blank starts a chunk. The bytes of all tokens are compared with
        the text's at once.
        """
        left: list[str] = []
        mark = blank.encode()
        for k in range(0, len(chunks), 4096):
            some = chunks[k:k + 4096]
            text = "".join(blank + c.lstrip(blank) for c in some)
            x = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
            y: list[int] = []
            for i in range(0, len(some), each):
                part = "".join(blank + c.lstrip(blank) for c in some[i:i + each])
                found = self.b.encode(part[1:] if blank == " " else part, num_threads=1)
                y += found if blank == " " else found[1:]
            raw = text.encode()
            sides = []
            for ids, names, first in ((x, self.bytes_a, self.first_a), (y, self.bytes_b, self.first_b)):
                own = np.array(ids, np.uint16)
                starts = np.flatnonzero(first[own] == mark[0])
                sides.append((own.tobytes(), [*(2 * starts).tolist(), 2 * len(own)], b"".join(map(names.__getitem__, ids)) == raw))
            if all(ok and len(starts) == len(some) + 1 for _, starts, ok in sides):
                for (ids, starts, _), memo in zip(sides, (self.ids_a, self.ids_b), strict=True):
                    memo.update((c, ids[i:j]) for c, i, j in zip(some, starts, starts[1:], strict=False))
            else:
                left += some
        return left

    def learn(self, chunks: list[str]) -> None:
        """Ids of chunks that aren't in the memo."""
        words, lines, rest, marked = {}, [], [], []
        for c in chunks:
            if c[-1] in _MARKS and self.parts_marks and c[:-1].isalpha():
                marked.append(c)  # neither tokenizer joins a letter and a mark after it
                if c[:-1] not in self.ids_a:
                    words[c[:-1]] = None
            elif " " in c or _SPACE in c or c[-1].isspace() or c[0].isspace() and not (c[0] == "\n" and c[1:].isalpha()):
                rest.append(c)
            elif c[0] == "\n":
                lines.append(c)
            else:
                words[c] = None
        rest += self._run(list(words), " ", 64) + self._run(lines, "\n", 64)
        full = [c if c[0] in " \n" else " " + c for c in rest]
        found_a = self.a.encode_batch_fast(full, add_special_tokens=False)
        # B puts a blank before a text, which is the first one here; before a line feed it is taken off again
        found_b = self.b.encode([f if f[0] == "\n" else f[1:] for f in full], num_threads=1)
        for c, f, x, y in zip(rest, full, found_a, found_b, strict=True):
            ids, raw = x.ids, f.encode()
            y = y[1:] if f[0] == "\n" else y
            if (b"".join(map(self.bytes_a.__getitem__, ids)) != raw or b"".join(map(self.bytes_b.__getitem__, y)) != raw):
                self.bad.add(c)
            self.ids_a[c] = array("H", ids).tobytes()
            self.ids_b[c] = array("H", y).tobytes()
        for c in marked:
            if c[:-1] in self.bad:
                self.bad.add(c)
            for memo, ids in ((self.ids_a, self.marks_a), (self.ids_b, self.marks_b)):
                memo[c] = memo[c[:-1]] + ids[c[-1]]

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of A and of B of each text; none where the bytes of one aren't those of the text.

        Distinct chunks are looked up; the lists of all chunks are taken and flattened by Arrow.
        """
        if len(self.ids_a) > self.memo:
            self.forget()
        cut = self.cut(texts)
        coded = cut.flatten().dictionary_encode()
        met = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [c for c in met if c not in self.ids_a]
        if new:
            self.learn(new)
        n_chunks, indices = pc.list_value_length(cut), coded.indices
        if self.bad and any(odd := [c in self.bad for c in met]):
            hit = np.array(odd)[indices.to_numpy()]
            parent = pc.list_parent_indices(cut).to_numpy()
            lost = np.bincount(parent[hit], minlength=len(cut)) > 0
            indices = indices.filter(pa.array(~lost[parent]))
            n_chunks = pc.if_else(pa.array(lost), 0, n_chunks)
        edge = np.concatenate([[0], np.cumsum(n_chunks.to_numpy())])
        out = []
        for memo in (self.ids_a, self.ids_b):
            per_chunk = _lists([memo[c] for c in met]).take(indices)
            total = np.concatenate([[0], np.cumsum(pc.list_value_length(per_chunk).to_numpy())])
            out.append(pa.ListArray.from_arrays(pa.array(total[edge].astype(np.int32)), per_chunk.flatten()))
        return out[0], out[1]

    def forget(self) -> None:
        self.ids_a: dict[str, bytes] = {"": b""}
        self.ids_b: dict[str, bytes] = {"": b""}
        self.bad: set[str] = set()


def _lists(ids: list[bytes]) -> pa.ListArray:
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.uint16)))


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """One pair of tokenizers for each Python worker."""
    return Tokenizers(path_a, path_b)


def ends(ids: pa.ListArray, sizes: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(document, byte offset in the document at which the token ends) of every token."""
    parent = pc.list_parent_indices(ids)
    size = pc.take(sizes, pc.list_flatten(ids))
    total = pc.cumulative_sum(size)
    first = pc.take(ids.offsets.cast(pa.int64()), parent)  # position of the document's first token
    before = pc.subtract(pc.take(total, first), pc.take(size, first))
    return parent.cast(pa.int64()), pc.subtract(total, before)


def align(a: pa.ListArray, b: pa.ListArray, size_a: pa.Array, size_b: pa.Array) -> pa.Table:
    """Links in order: doc, a and b (positions among all tokens), common (both end there).

    Each document's tokens must cover the same number of bytes on both sides.
    """
    sides = []
    for name, ids, sizes in (("a", a, size_a), ("b", b, size_b)):
        doc, end = ends(ids, sizes)
        key = pc.bit_wise_or(pc.shift_left(doc, pa.scalar(32, pa.int64())), end)
        sides.append(pa.table({"key": key, name: pa.array(np.arange(len(key)))}))
    both = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    common = pc.and_(both["a"].is_valid(), both["b"].is_valid())
    return pa.table({"doc": pc.shift_right(both["key"], pa.scalar(32, pa.int64())), "a": pc.fill_null_backward(both["a"]),
                     "b": pc.fill_null_backward(both["b"]), "common": common})


def _starts(per_doc: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32))


def group_texts(links: pa.Table, a: pa.ListArray, b: pa.ListArray, name_a: pa.Array, name_b: pa.Array) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    cuts = links.filter(links["common"])
    sides = []
    for name, ids, names in (("a", a, name_a), ("b", b, name_b)):
        last = np.concatenate([[0], cuts[name].to_numpy() + 1]).astype(np.int32)
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(last), pc.take(names, pc.list_flatten(ids))), ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    of_doc = np.bincount(cuts["doc"].to_numpy(), minlength=len(a))
    return pc.binary_join(pa.ListArray.from_arrays(_starts(of_doc), groups), ";").to_pylist()


def _groups(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def linked(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Stored (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links): ``links`` holds the id
    pair (a * 65536 + b, as a signed 32-bit number) of each link."""
    paths = path_a or public_tokenizers.path(A), path_b or public_tokenizers.path(B)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*paths)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in _groups(texts, GROUP):
                a, b = own.encode(texts[start:end])
                links = align(a, b, own.size_a, own.size_b)
                n = len(a)
                doc = links["doc"].to_numpy()
                n_links = np.bincount(doc, minlength=n)
                n_groups = np.bincount(doc[links["common"].to_numpy()], minlength=n)
                sha = [hashlib.sha256(t.encode()).hexdigest() if t else ""
                       for t in group_texts(links, a, b, own.name_a, own.name_b)]
                id_a, id_b = (pc.take(pc.list_flatten(x), links[c]).to_numpy() for x, c in ((a, "a"), (b, "b")))
                pair = (id_a.astype(np.uint32) << np.uint32(16) | id_b).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], pc.list_value_length(a).cast(pa.int64()),
                     pc.list_value_length(b).cast(pa.int64()), pa.array(n_groups, pa.int64()), pa.array(n_links, pa.int64()),
                     pa.array(sha, pa.string()), pa.ListArray.from_arrays(_starts(n_links), pa.array(pair))],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return staged(rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                       "groups_sha256 string, links array<int>"), "token_links", "zstd")


def _portions(links: pa.ListArray) -> Iterator[pa.ListArray]:
    """Runs of documents of about ``LINKS`` links."""
    total = np.cumsum(pc.list_value_length(links).to_numpy())
    cuts = np.flatnonzero(np.diff(total // LINKS, append=-1)) + 1
    at = 0
    for end in cuts.tolist():
        yield links[at:end]
        at = end


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Stored (pair, b, n, best): links of each id pair in all documents; ``best``: no pair of the same
    B id has more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"pair": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})

        def merged(t: pa.Table) -> pa.Table:
            return t.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})

        for batch in batches:
            for links in _portions(batch.column(0)):
                flat = pa.table({"pair": pc.list_flatten(links)})
                some = flat.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns({"count_all": "n"})
                held = merged(pa.concat_tables([held, some.select(["pair", "n"])]))
                if len(held) > MOST_PAIRS:
                    yield from held.select(["pair", "n"]).to_batches()
                    held = held.slice(0, 0)
        yield from held.select(["pair", "n"]).combine_chunks().to_batches()

    n = aligned.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = staged(n.withColumn("b", F.col("pair").bitwiseAND(_B_ID - 1)), "token_pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    return staged(n.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best")), "token_pairs")


def with_counts(aligned: DataFrame, counts: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Adds n_best and count_sum, slice by slice of the pairs, and drops the links."""
    spark = aligned.sparkSession
    slices = max(1, -(-counts.count() // most_pairs))
    own = [c for c in aligned.columns if c != "links"]
    out = aligned.select(*own, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"), "links")
    for k in range(slices):
        # a slice holds about most_pairs pairs: they are dealt by hash
        some = counts.where(F.pmod(F.xxhash64("pair"), F.lit(slices)) == k).select("pair", "n", "best").toArrow()
        sent = spark.sparkContext.broadcast(some.combine_chunks())
        last = k == slices - 1
        names = [*own, "n_best", "count_sum"] + ["links"] * (not last)
        kinds = {f.name: f.dataType.simpleString() for f in out.schema.fields}

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last, names=names) -> Iterator[pa.RecordBatch]:
            table = sent.value
            pairs = table["pair"].combine_chunks()
            n = np.append(table["n"].to_numpy(), 0)
            best = np.append(table["best"].to_numpy(zero_copy_only=False).astype(np.int64), 0)
            for batch in batches:
                add_n, add_best = [], []
                for links in _portions(batch.column("links")):
                    at = pc.fill_null(pc.index_in(pc.list_flatten(links), pairs), len(pairs)).to_numpy()
                    edge = links.offsets.to_numpy() - links.offsets[0].as_py()
                    for found, out_ in ((n, add_n), (best, add_best)):
                        total = np.concatenate([[0], np.cumsum(found[at])])
                        out_.append(total[edge[1:]] - total[edge[:-1]])
                columns = {name: batch.column(name) for name in batch.schema.names}
                for name, more in (("n_best", add_best), ("count_sum", add_n)):
                    columns[name] = pc.add(columns[name], pa.array(np.concatenate(more)))
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

        out = out.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names))
        if not last:
            out = staged(out, "token_links", "zstd")
    return out


def alignment(docs: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    aligned = linked(docs)
    found = with_counts(aligned, pair_counts(aligned), most_pairs)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
