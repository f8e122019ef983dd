"""Decontamination, alignment and spelling variants: against brute force on small fixtures."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quarry.llm import alignment, blocked_bloom, spelling, winnowing

rng = random.Random(11)
EXTRA = ", word string, n long, runs string, key string, window string, links int, pair int, h long, n_a int, root string"
SCHEMA = "doc_id long, text string" + EXTRA
NONE = (None,) * EXTRA.count(",")


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, *NONE) for r in rows], schema)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- Bloom filters ---------------------------------------------------------------------------------


def test_blocked_bloom_finds_every_key(spark):
    keys = [(s, rng.getrandbits(64) - (1 << 63)) for s in (3, 7, 8) for _ in range(700 * s)]
    shape = blocked_bloom.Shape(dict(Counter(s for s, _ in keys)))
    words = blocked_bloom.fill(spark.createDataFrame(keys + keys[:50], "shard int, h long"), shape)
    for s in (3, 7, 8):
        own = np.array([h for t, h in keys if t == s]).view(np.uint64)
        assert len(blocked_bloom.found(words, shape, s, own)) == len(own)
        foreign = np.array([rng.getrandbits(64) for _ in range(20_000)], np.uint64)
        assert len(blocked_bloom.found(words, shape, s, foreign)) < 400
    assert len(blocked_bloom.found(words, shape, 5, own)) == 0
    assert blocked_bloom.Shape({1: 10**9}).words * 8 <= blocked_bloom.MOST_BYTES


# --- winnowing ------------------------------------------------------------------------------------

VOCABULARY = ["ab", "c", "dé", "E5", "ñ", "x"]


def some_words(most):
    return " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(0, most)))


def hits_of(doc_rows, item_rows):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in item_rows:
        w = word.findall(lower(text))
        spans = [tuple(w[i:i + 10]) for i in range(len(w) - 9)] if len(w) >= 10 else [tuple(w)] if w else []
        for s in spans if item is not None else []:
            windows.setdefault(s, set()).add(str(item))
    out = []
    for doc, text in doc_rows:
        w, hit, items = word.findall(lower(text)), set(), set()
        for n in {len(s) for s in windows}:
            for i in range(len(w) - n + 1):
                if (s := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    items |= windows[s]
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(items), sha, bool(hit)))
    return sorted(out, key=str)


def test_decontaminate_equals_brute_force(spark):
    items = [(i, some_words(30)) for i in range(40)] + [(50, None), (51, ""), (52, "C, ab"), (None, "dé ñ"), (52, "C, ab")]
    items += [(60 + i, "E5 ab ñ x c x c ab E5 x c c ab x") for i in range(12)]
    passage = "The quick-brown 狐 jumps over A lazy dog and then; it Sleeps for 12 hours straight"
    items.append((9, passage))
    docs = [(i, some_words(60)) for i in range(150)]
    docs += [(200, None), (201, ""), (202, "c"), (202, "c"), (203, " .. \n"), (None, "c ab c ab"),
             (204, "Intro. " + passage.upper().replace(" ", "\n") + " outro"), (205, passage[:40]),
             (206, "zz " * 3000 + passage + " zz" * 3000)]
    docs += [(300 + i, f"start {i} {passage} end {i}") for i in range(60)]  # a hot passage
    got = winnowing.decontaminate(frame(spark, docs), frame(spark, items, SCHEMA.replace("doc_id", "item_id")))
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == hits_of(docs, items)


def test_decontaminate_empty_tables(spark):
    none = frame(spark, [])
    items = none.withColumnRenamed("doc_id", "item_id")
    assert winnowing.decontaminate(none, items).count() == 0
    got = winnowing.decontaminate(frame(spark, [(1, "a b")]), items).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got] == [(1, 2, 0, False)]


def test_winnowing_keeps_one_gram_of_every_window():
    text = winnowing.normal(" ".join(rng.choice(["a", "b", "c"]) for _ in range(300)))
    grams = winnowing.Grams([text, b"", winnowing.normal("one Two")])
    for length in (1, 2, 5, 10):
        at = grams.spans(length)
        where, best = winnowing.prints(grams, at, length)
        k = (length + 1) // 2
        same = {}
        for a, p, h in zip(at.tolist(), where.tolist(), best.tolist(), strict=True):
            own = [int(grams.hashes(np.array([i]), k)[0]) for i in range(a, a + length - k + 1)]
            assert h == min(own) and p == a + own.index(h)
            # equal windows keep their k-gram at the same place
            assert same.setdefault(grams.words(a, length), p - a) == p - a


# --- alignment -------------------------------------------------------------------------------------

ODD = [None, "", " ", "\n", "a", " a", "a ", "a\n\nb", "x \n y", "<|endoftext|> <s> <0x41>", "▁x", "a▁b c", "tab\tx y",
       " q 　w", "é \x00 z", "😀 😀\n😀", "don't won't  'll", "a\r\nb \r c", "\x1c a\x1cb c", "1 2 3\n4 55 666",
       "﻿bom x", "a\x85b c\x85 d", "​ x​ y", "word " * 3000, "same words here\nsame words here"]
PARTS = [*" \n  ab'sé▁ß\t\r1,.<>|😀\x1c\x85 ", "the", "ing"]


def aligned_by_hand(rows):
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path(alignment.A))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=P.path(alignment.B))
    ranks = dict(reversed(line.split()) for line in open(P.path("byte_bpe_50k.tiktoken"), "rb") if line.strip())
    import base64
    raw_a = {int(i): base64.b64decode(t) for i, t in ranks.items()}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    raw_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    count, found = Counter(), []
    for doc, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if text and not b"".join(raw_a[i] for i in x) == b"".join(raw_b[i] for i in y) == whole:
            x, y = [], []
        own_a = [k for k, i in enumerate(x) for _ in raw_a[i]]  # token of each byte
        own_b = [k for k, i in enumerate(y) for _ in raw_b[i]]
        links = sorted(set(zip(own_a, own_b, strict=True)))
        ends_a = {len(own_a) - own_a[::-1].index(k) for k in set(own_a)}
        cuts = sorted(ends_a & {len(own_b) - own_b[::-1].index(k) for k in set(own_b)})
        groups = []
        for s, e in zip([0, *cuts], cuts, strict=False):
            groups.append(",".join(str(x[k]) for k in sorted(set(own_a[s:e]))) + "|" + ",".join(str(y[k]) for k in sorted(set(own_b[s:e]))))
        pairs = [(x[i], y[j]) for i, j in links]
        count.update(pairs)
        found.append((doc, len(x), len(y), groups, pairs))
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return sorted(((doc, n_a, n_b, len(g), len(p), sum(count[q] == most[q[1]] for q in p), sum(count[q] for q in p),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for doc, n_a, n_b, g, p in found), key=str)


@pytest.mark.parametrize("most_pairs", [alignment.MOST_PAIRS, 40])
def test_alignment_equals_brute_force(spark, most_pairs):
    rows = list(enumerate([*ODD, *("".join(rng.choice(PARTS) for _ in range(rng.randint(1, 60))) for _ in range(150))]))
    rows += [(None, "no id here"), rows[-1], rows[-1]]
    got = alignment.alignment(frame(spark, rows), most_pairs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, got), key=str) == aligned_by_hand(rows)


def test_chunked_ids_equal_the_libraries():
    import public_tokenizers as P
    own = alignment.Tokenizers(P.path(alignment.A), P.path(alignment.B), memo=30)
    parts = [*PARTS, "Word", "word", "word,", "Été.", "naïve,", "x.y", "日本語", "日本。", "ﬁn", "ǅ", "a\u0301", "\n", "\n", " ", " "]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(20)]
        a, b = own.encode(texts)
        for t, x, y in zip(texts, a.to_pylist(), b.to_pylist(), strict=True):
            want_a = own.a.encode(" " + t, add_special_tokens=False).ids if t else []
            want_b = own.b.encode(t) if t else []
            raw = (" " + t).encode()
            if t and not b"".join(own.bytes_a[i] for i in want_a) == b"".join(own.bytes_b[i] for i in want_b) == raw:
                want_a, want_b = [], []
            assert (x, y) == (want_a, want_b), repr(t)


def test_alignment_empty_table(spark):
    assert alignment.alignment(frame(spark, [])).count() == 0
    got = alignment.alignment(frame(spark, [(1, None)])).collect()
    assert [(r.n_links, r.count_sum, r.groups_sha256) for r in got] == [(0, 0, "")]


def test_ends_are_segmented():
    ids = pa.array([[0, 1], [], [1], [2, 2, 0]], pa.list_(pa.uint16()))
    doc, end = alignment.ends(ids, pa.array([1, 3, 10]))
    assert doc.to_pylist() == [0, 0, 2, 3, 3, 3] and end.to_pylist() == [1, 4, 3, 10, 20, 21]
    part = ids.slice(2, 2)  # offsets that don't start at 0 are made to by the caller
    assert pc.list_value_length(part).to_pylist() == [1, 3]


# --- spelling variants -----------------------------------------------------------------------------

STEMS = ["planet", "planets", "plànets", "gardens", "garden", "Mountain", "fountain", "mountains", "ÉTÉétés", "étéétés"]


def variant(word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abzé×ÿ") + word[at:],
                       word[:at] + rng.choice("abzé×ÿ") + word[at + 1:], word])


def variants_by_hand(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            count[w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        s, t = sorted((a, b), key=len)
        return len(t) == len(s) + 1 and any(t[:i] + t[i + 1:] == s for i in range(len(t)))

    near_words = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, found in near_words.items():
        if found and words[best := min(found, key=lambda x: (-words[x], x))] >= 5 * words[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near_words[w]), words.get(form.get(w))) for w, n in words.items()), key=str)


@pytest.fixture(scope="module")
def spelled():
    rows = [(None, "planet " * 7), (0, None), (1, ""), (2, "short a b"), (3, "gardens " * 4000), (4, "ab-garden_garden garden9garden")]
    for i in range(5, 400):
        stem = rng.choice(STEMS)
        word = stem if rng.random() < 0.7 else variant(variant(stem) if rng.random() < 0.4 else stem)
        rows.append((i, f"{word}, {word}! {word.upper()} {rng.choice(STEMS)} " * rng.choice([1, 1, 2, 5, 25])))
    return [*rows, rows[-1], rows[-1]]


@pytest.mark.parametrize("most_bytes", [blocked_bloom.MOST_BYTES, 128])
def test_spelling_equals_brute_force(spark, spelled, most_bytes):
    got = spelling.spelling_variants(frame(spark, spelled), most_bytes).select("word", "form", "root", "n", "n_near", "form_n")
    want = variants_by_hand(spelled)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain of two forms


def test_spelling_slips_are_there(spelled):
    hit = sum(not zlib.crc32(f"{d}:{w}".encode()) % 199 for d, t in spelled if d is not None for w in set(spelling.runs(t or "")))
    assert hit > 2


def test_spelling_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0


def test_roots_of_long_chains(spark):
    links = spark.range(300).select(F.format_string("w%03d", "id").alias("word"), F.format_string("w%03d", F.col("id") + 1).alias("form"))
    assert {r.root for r in spelling.roots(links).collect()} == {"w300"}
