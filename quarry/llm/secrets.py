"""Secret scans with multipart credential linking.

Strong spans are reported for themselves: assignments, access keys, long hex
runs. Weak parts are reported only together: an access identifier
(``access_key_id: ...``), a bare secret (base64 of 32+ characters with letters
of both cases and digits) and an endpoint (``https://...``, ``s3://...``,
``host=...``) tell something only when complementary parts lie close by.

1. One scan of the texts finds all spans, per row, as arrays of (kind, start,
   end) in code points. ``split`` gives the pieces between the matches and
   ``regexp_extract_all`` the matches, so positions are running lengths.
   The arrays are stored without the texts.
2. Interval join: parts are dealt into scopes (row, start div ``scope``), each
   scope and kind is reduced to its largest end and smallest start, and a weak
   part looks up the complementary kinds in its own and the neighbouring scopes.
   No pair of parts is ever emitted, so a text full of parts costs its length.

Weak identifiers need a secret (weak or strong) within ``scope`` code points,
weak secrets an identifier (weak or strong), endpoints both.

Defined results: a null or empty text has no spans; rows with equal id and text
get equal spans; spans may overlap; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import framed, let, staged, text_of, unframed

# Fixed values of the contract: kinds in their order, patterns, smallest lengths.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (HEX, 0, 24)}

#: Weak parts: pattern, and group whose length counts with its smallest length.
WEAK = {
    "ident": (r"(?i:access_?key_?id|client_?id|key_?id|user_?name|login)[\"']?\x20*[:=]\x20*[\"']?"
              r"([A-Za-z0-9+/_.@-]+)", 1, 4),
    # the look-aheads see the whole run; it has one start, so they cost its length
    "bare": (r"(?<![A-Za-z0-9+/])(?=[A-Z0-9+/]*+[a-z])(?=[a-z0-9+/]*+[A-Z])"
             r"(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    "endpoint": (r"(?:https?|s3|gs|amqps?|redis|postgres(?:ql)?|mysql|mongodb(?:\+srv)?)://[^\s\"'<>]+"
                 r"|(?i:host|endpoint|region)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:/_-]+", 0, 6),
}
KINDS = (*BASE, *WEAK)
SCOPE = 400
_ORDER = {k: i for i, k in enumerate(KINDS)}
_SPAN = "array<struct<start:int,end:int,kind:int>>"
#: What a weak part needs close by: one of each tuple.
_NEEDS = {"ident": (("assign", "bare"),), "bare": (("ident", "access"),),
          "endpoint": (("ident", "access"), ("assign", "bare"))}
# A text without any of these has no match; cheap substring tests before the patterns.
_HINTS = {"access": ("AKIA",), "endpoint": ("://", "=", ":"), "ident": ("=", ":"), "assign": ("=", ":")}


def matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches whose ``group`` has ``least`` characters."""
    def spans(found: Column) -> Column:
        def placed(gaps: Column) -> Column:
            size = F.transform(found, lambda m: F.length(m))
            # running (end so far, starts): piece i lies before match i
            run = F.aggregate(
                F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(found)), lambda g: F.length(g)).alias("gap"),
                             size.alias("size")),
                F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
                lambda a, x: F.struct((a["at"] + x["gap"] + x["size"]).alias("at"),
                                      F.concat(a["starts"], F.array(a["at"] + x["gap"])).alias("starts")))
            parts = (F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda g: F.length(g))
                     if group else size)
            zipped = F.arrays_zip(run["starts"].alias("start"), size.alias("size"), parts.alias("part"))
            return F.transform(F.filter(zipped, lambda z: z["part"] >= least), lambda z: F.struct(
                z["start"].alias("start"), (z["start"] + z["size"]).alias("end"),
                F.lit(_ORDER[kind]).alias("kind")))

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), placed))

    found = F.coalesce(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans),
                       F.array().cast(_SPAN))
    if kind in _HINTS:
        hint = F.lit(False)
        for h in _HINTS[kind]:
            hint = hint | F.contains(text, F.lit(h))
        found = F.when(hint, found).otherwise(F.array().cast(_SPAN))
    return found.cast(_SPAN)


def long_hex(text: Column) -> Column:
    """Runs of [0-9a-f] with 24+ characters; a run of that length is matched from its start
    and whole, so the bounded pattern finds what ``HEX`` finds after its length test."""
    _, _, least = BASE["hex"]
    return matches(text, "hex", HEX[:-1] + "{%d,}" % least, 0, least)


def find_parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base (all strong spans), weak (all weak parts); no text."""
    text = text_of()
    strong = {k: matches(text, k, *v) for k, v in BASE.items() if k != "hex"} | {"hex": long_hex(text)}
    weak = {k: matches(text, k, *v) for k, v in WEAK.items()}
    return (docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"),
                        *[c.alias(f"s_{k}") for k, c in strong.items()],
                        *[c.alias(f"w_{k}") for k, c in weak.items()])
            .select("doc_id", "text_hash",
                    F.array_sort(F.concat(*[f"s_{k}" for k in strong])).alias("base"),
                    F.array_sort(F.concat(*[f"w_{k}" for k in weak])).alias("weak")))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, text_hash, extra): weak parts whose complementary parts lie in scope.

    Two parts lie in scope if at most ``scope`` code points are between them. They
    then touch the same scope or neighbouring ones: in the same one they are close
    for certain; of the one before only the largest end counts, of the one after
    only the smallest start.
    """
    key = ["doc_id", "text_hash"]
    rows = (parts.where(F.size("weak") > 0)
            .select(*key, F.explode(F.concat("base", "weak")).alias("p")).select(*key, "p.*").distinct()
            .withColumns({"first": F.floor(F.col("start") / scope), "last": F.floor(F.col("end") / scope)}))
    at = F.col("at")
    met = rows.withColumn("at", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)))
    by_kind = met.groupBy(*key, "at", "kind").agg(
        F.max(at.between(F.col("first"), F.col("last"))).alias("same"),
        F.max(F.when(at > F.col("last"), F.col("end"))).alias("before"),
        F.min(F.when(at < F.col("first"), F.col("start"))).alias("after"))
    near = by_kind.groupBy(*key, "at").agg(F.map_from_entries(F.collect_list(  # one entry per kind
        F.struct("kind", F.struct("same", "before", "after")))).alias("near"))
    weak = (rows.where(F.col("kind") >= len(BASE))
            .withColumn("at", F.explode(F.sequence(F.col("first"), F.col("last"))))
            .join(near.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("at").alias("_at"), "near"),
                  F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("text_hash").eqNullSafe(F.col("_h"))
                  & (at == F.col("_at"))))

    def close(*kinds: str) -> Column:
        found = F.lit(False)
        for kind in kinds:
            n = F.col("near")[F.lit(_ORDER[kind])]
            found = found | F.coalesce(n["same"], F.lit(False)) | F.coalesce(
                n["before"] >= F.col("start") - scope, F.lit(False)) | F.coalesce(
                n["after"] <= F.col("end") + scope, F.lit(False))
        return found

    groups = sorted({g for needs in _NEEDS.values() for g in needs})
    seen = weak.groupBy(*key, "start", "end", "kind").agg(
        *[F.max(close(*g)).alias(f"g{i}") for i, g in enumerate(groups)])
    ok = F.lit(False)
    for kind, needs in _NEEDS.items():
        all_met = F.col("kind") == _ORDER[kind]
        for g in needs:
            all_met = all_met & F.col(f"g{groups.index(g)}")
        ok = ok | all_met
    return (seen.where(ok).groupBy(*key)
            .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).cast(_SPAN).alias("extra")))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, text_hash, base and spans (strong and linked weak), sorted by start, then kind."""
    parts = staged(find_parts(docs), "secret_parts")
    extra = linked(parts, scope).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "extra")
    both = parts.join(extra, F.col("doc_id").eqNullSafe(F.col("_d"))
                      & F.col("text_hash").eqNullSafe(F.col("_h")), "left")
    spans = F.concat("base", F.coalesce("extra", F.array().cast(_SPAN)))
    return both.select("doc_id", "text_hash", _by_start(F.col("base")).alias("base"),
                       _by_start(spans).alias("spans"))


def _by_start(spans: Column) -> Column:
    """Sorted by start, then kind, then end."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(keyed)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, hash of the strong spans, all spans."""
    found = find_secrets(docs)

    def n(kind: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == _ORDER[kind]

    return found.select(
        "doc_id", *[F.size(F.filter("base", n(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_linked"))


def merged(spans: Column) -> Column:
    """Non-overlapping (start, end, kind) covering ``spans`` (sorted by start)."""
    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), last["kind"].alias("kind"),
                         F.greatest(last["end"], s["end"]).alias("end"))
        return (F.when((F.size(done) > 0) & (last["end"] >= s["start"]),
                       F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(grown)))
                .otherwise(F.concat(done, F.array(s))))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,kind:int,end:int>>"), add)


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by ``[kind]``; ``n_chars``, if there, follows.

    Only rows with spans meet the small table of spans; the other texts pass
    through the join by id and text hash.
    """
    names = docs.columns
    found = find_secrets(docs, scope).where(F.size("spans") > 0)
    hits = staged(found.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"),
                               merged(F.col("spans")).alias("_s")).distinct(), "secret_spans")
    text = F.col("_text")
    labels = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def cut(s: Column) -> Column:
        pieces = F.transform(s, lambda x, i: F.concat(
            F.substring(text, F.when(i > 0, F.get(s, F.greatest(i - 1, F.lit(0)))["end"]).otherwise(F.lit(0)) + 1,
                        x["start"] - F.when(i > 0, F.get(s, F.greatest(i - 1, F.lit(0)))["end"]).otherwise(F.lit(0))),
            F.get(labels, x["kind"])))
        return F.concat(F.array_join(pieces, ""),
                        F.substring(text, F.element_at(s, -1)["end"] + 1, F.length(text)))

    own = framed(docs, F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.xxhash64("text").alias("_t"))
    joined = own.join(hits, F.col("_id").eqNullSafe(F.col("_d")) & F.col("_t").eqNullSafe(F.col("_h")), "left")
    hit = F.col("_s").isNotNull()
    joined = joined.withColumn("_text", F.when(hit, cut(F.col("_s"))).otherwise(text))
    changed = {"text": text, "n_chars": F.when(hit, F.length(text).cast("long")).otherwise(F.col("_doc.n_chars"))
               if "n_chars" in names else None}
    return joined.select(*[c if n not in changed else changed[n].alias(n)
                           for n, c in zip(names, unframed(names), strict=True)])
