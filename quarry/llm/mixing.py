"""Mixing to target weights with soft memberships.

1. Domain classifier: naive Bayes over binned letter rates, learned from a
   labelled table (doc_id, domain). A rate is a count of one probe string per
   character; bins are quantiles over the labelled rows. The likelihood is
   tempered, so posteriors stay soft.
2. Rates: with w = tokens / all tokens and posteriors p, the expected share of
   domain k is S_k = sum of w * rate * p_k. Projected gradient descent minimises
   sum_k (S_k - target_k)^2 / c_k + ridge * sum w (rate - 1)^2 over rates >= 0,
   c_k being the share at rate 1. In the metric of w the step 1 / (1 + ridge) is
   safe (the matrix of the first term, scaled by c, is stochastic). A step is
   one aggregation of K sums; only those reach the driver.
   A domain without a target has its present share as target.
3. ``scale`` of the targets: the smallest for which no domain has to shrink
   (each is repeated, none thrown away), or a given number. In the first case rates
   are projected onto rate >= 1, so every document stays; as the soft memberships of
   repeated documents add to the other domains, the scale is enlarged until the
   bound costs nothing. Where no scale does that (the wanted mix isn't one of the
   documents' memberships) the targets are approached: ``target_gap`` says how far off
   the largest share is. A fit that doesn't settle raises.
4. Copies: a rate is rounded up or down by a hash of its row, so that emitted tokens
   have the rates' shares in expectation.

All counts cover whole texts and every row. Defined results: a null or empty
text has no tokens, weight 0, the prior as posterior and rate 1; labels of
unknown documents or with a null domain are ignored; without labels, or for an empty table, all
rates are 1; repeated rows are weighed each; other columns are kept apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import framed, let, literals, staged, text_of, unframed, words_of

#: Strings whose rates describe a text.
PROBES = ("a", "e", "h", "o", "u", "w", "é", "ê", "ç", "ó", "ñ", "ä", "ü", "ß", "%", "|", "!")
BINS = 8
TEMPERATURE = 3.0
RIDGE = 0.02
#: Steps that one expression holds before the rates are written.
STEPS_HELD = 24
#: Target weights of the registered query and the pipeline.
TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}


def rates(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, n_tokens (words), r (rates of the probes)."""
    text = text_of()
    size = F.greatest(F.length(text), F.lit(1))
    counts = [(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(p), F.lit(""))))
              / F.lit(float(len(p.encode()))) / size for p in PROBES]
    return docs.select(*keep, F.size(words_of(text)).cast("long").alias("n_tokens"),
                       F.array(*counts).alias("r"))


def learn_domains(rated: DataFrame, labelled: DataFrame, bins: int = BINS,
                  temperature: float = TEMPERATURE) -> dict | None:
    """Bin edges, priors and tempered log likelihoods; None without labelled rows.

    ``labelled``: (doc_id, domain). The driver sees quantiles and one count per
    (probe, bin, domain).
    """
    marks = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(
        F.min("domain").alias("domain"))
    rows = staged(rated.where("n_tokens > 0").join(marks, "doc_id").select("domain", "r"), "mix_labelled")
    steps = [(i + 1) / bins for i in range(bins - 1)]
    marks = rows.agg(*[F.percentile_approx(F.get("r", F.lit(i)), steps, 2000).alias(f"q{i}")
                       for i in range(len(PROBES))]).first()
    if marks["q0"] is None:
        return None
    edges = [list(marks[f"q{i}"]) for i in range(len(PROBES))]
    found = (rows.select("domain", F.posexplode(_bins(edges)).alias("i", "b"))
             .groupBy("domain", "i", "b").count().collect())
    domains = sorted({r["domain"] for r in found})
    seen = {(r["domain"], r["i"], r["b"]): r["count"] for r in found}
    total = {d: sum(seen.get((d, 0, b), 0) for b in range(bins)) for d in domains}
    import math
    all_rows = sum(total.values())
    return {
        "domains": domains, "edges": edges, "bins": bins,
        "prior": [math.log(total[d] / all_rows) for d in domains],
        "weights": [[math.log((seen.get((d, i, b), 0) + 0.5) / (total[d] + 0.5 * bins)) / temperature
                     for i in range(len(PROBES)) for b in range(bins)] for d in domains]}


def _bins(edges: list[list[float]]) -> Column:
    """Bin number of every rate: the edges at or below it."""
    table = F.array(*[literals(e) for e in edges])
    return F.transform(F.col("r"), lambda v, i: F.size(F.filter(F.get(table, i), lambda t: t < v)))


def posteriors(rated: DataFrame, model: dict) -> DataFrame:
    """Adds ``p``: domain probabilities in the order of ``model['domains']``."""
    n = model["bins"]

    def score(prior: float, weights: list[float]) -> Column:
        w = literals(weights)
        return F.aggregate(F.transform("_b", lambda b, i: F.get(w, i * n + b)), F.lit(prior), lambda a, x: a + x)

    def soft(s: Column) -> Column:
        return let(F.array_max(s), lambda top: let(
            F.transform(s, lambda x: F.exp(x - top)),
            lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda t: F.transform(e, lambda x: x / t))))

    scores = [F.when(F.col("n_tokens") > 0, score(a, w)).otherwise(F.lit(a))
              for a, w in zip(model["prior"], model["weights"], strict=True)]
    return (rated.withColumn("_b", _bins(model["edges"])).withColumn("_s", F.array(*scores))
            .withColumn("p", soft(F.col("_s"))).drop("_b", "_s"))


def _scale_for(share: list[float], goal: list[float], both: list[list[float]], ridge: float, least: float) -> float:
    """Smallest scale at which the unbounded fit has no rate under ``least`` (at most 1); 0 if none has.

    Its rates are 1 + sum of b_k p_k with (both + ridge diag(share)) b = scale goal - share,
    and ``both`` sums to ``share``: b = scale u - 1 / (1 + ridge).
    """
    import numpy as np
    c = np.maximum(share, 1e-9)
    u = np.linalg.lstsq(np.array(both) + ridge * np.diag(c), np.array(goal), rcond=None)[0]
    return float((least - 1 + 1 / (1 + ridge)) / u.min()) if u.min() > 0 else 0.0


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float],
              scale: float | None = None, ridge: float = RIDGE, least: float = 0.0, tolerance: float = 1e-4,
              max_steps: int = 500) -> tuple[DataFrame, list[dict]]:
    """Adds ``rate`` (``least`` or more) and ``target_gap`` to rows with n_tokens and p; and the shares after every step.

    Domains without a target keep their present share; the targets are scaled to sum to the rest.
    ``target_gap``: largest distance of a reached share from its target, as shares of all tokens.
    """
    k = len(domains)
    total = rows.agg(F.sum("n_tokens").alias("n"),
                     *[F.sum(F.col("n_tokens") * F.get("p", F.lit(i))).alias(f"s{i}") for i in range(k)],
                     *[F.sum(F.col("n_tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))).alias(f"m{i}_{j}")
                       for i in range(k) for j in range(i, k)]).first()
    if not total["n"]:
        return rows.withColumns({"rate": F.lit(1.0), "target_gap": F.lit(0.0)}), []
    share = [total[f"s{i}"] / total["n"] for i in range(k)]
    own = [c if d not in targets else 0.0 for d, c in zip(domains, share, strict=True)]
    told = [max(0.0, targets.get(d, 0.0)) for d in domains]
    if not sum(told) and any(d in targets for d in domains):
        raise ValueError(f"none of the domains {domains} has a target above 0")
    rest = max(0.0, 1 - sum(own)) / (sum(told) or 1.0)
    goal = [o + g * rest for o, g in zip(own, told, strict=True)]
    if scale is None:
        scale = max(c / g for c, g in zip(share, goal, strict=True) if g)
        both = [[total[f"m{min(i, j)}_{max(i, j)}"] / total["n"] for j in range(k)] for i in range(k)]
        scale = max(scale, _scale_for(share, goal, both, ridge, least))
    goal = [g * scale for g in goal]
    now, history, step = share, [], 1 / (1 + ridge)
    held, rate = rows.withColumn("_r", F.lit(1.0)), F.col("_r")
    for done in range(1, max_steps + 1):
        pull = [step * (s - g) / max(c, 1e-9) for s, g, c in zip(now, goal, share, strict=True)]
        dot = reduce(lambda a, b: a + b, [F.get("p", F.lit(i)) * F.lit(x) for i, x in enumerate(pull)])
        rate = F.greatest(F.lit(float(least)), F.lit(1 - step * ridge) * rate - dot + F.lit(step * ridge))
        rated = held.withColumn("_r", F.when(F.col("n_tokens") > 0, rate).otherwise(F.lit(1.0)))
        got = rated.agg(*[F.sum(F.col("n_tokens") * F.col("_r") * F.get("p", F.lit(i))).alias(f"s{i}")
                          for i in range(k)]).first()
        before, now = now, [got[f"s{i}"] / total["n"] for i in range(k)]
        history.append(dict(zip(domains, now, strict=True)))
        if max(abs(a - b) for a, b in zip(before, now, strict=True)) < tolerance * max(1.0, scale):
            break
        if done % STEPS_HELD == 0:
            held, rate = staged(rated, "mix_steps"), F.col("_r")
    else:
        raise RuntimeError(f"rates did not settle in {max_steps} steps: {history[-1]}")
    reached = sum(now)
    gap = max(abs(s / reached - g / sum(goal)) for s, g in zip(now, goal, strict=True)) if reached and sum(goal) else 0.0
    return rated.withColumnRenamed("_r", "rate").withColumn("target_gap", F.lit(float(gap))), history


def fitted(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
           scale: float | None = None) -> tuple[DataFrame, list[str]]:
    """(doc_id, text_hash, n_tokens, p, rate, target_gap) for every row of ``docs``, and the domains."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    rated = staged(rates(keyed, "doc_id", "text_hash"), "mix_rates")
    model = learn_domains(rated, labelled)
    if model is None:
        return rated.withColumns({"p": F.array().cast("array<double>"), "rate": F.lit(1.0), "target_gap": F.lit(0.0)}).drop("r"), []
    rows = staged(posteriors(rated, model).drop("r"), "mix_posteriors")
    out, _ = fit_rates(rows, model["domains"], TARGETS if targets is None else targets, scale,
                       least=1.0 if scale is None else 0.0)
    return out, model["domains"]


def copies(rate: Column, *key: str) -> Column:
    """Whole number of copies: the rate rounded up or down by a hash of the row, so its mean is the rate."""
    u = F.shiftrightunsigned(F.xxhash64(*key, F.lit("copies")), 11) / F.lit(float(1 << 53))
    return F.floor(rate + u).cast("int")


def mixing_plan(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, n_tokens, domain (likeliest), posterior, rate, copies and target_gap of every document."""
    out, domains = fitted(docs, labelled)
    names = F.array(*[F.lit(d) for d in domains]).cast("array<string>")
    best = F.array_max("p")
    return out.select(
        "doc_id", "n_tokens", F.get(names, F.array_position("p", best).cast("int") - 1).alias("domain"),
        best.alias("posterior"), "rate", copies(F.col("rate"), "doc_id", "text_hash").alias("copies"), "target_gap")


def mix(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of ``docs``, each repeated by its copies."""
    out, _ = fitted(docs, labelled)
    n = staged(out.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"),
                          copies(F.col("rate"), "doc_id", "text_hash").alias("_n")).distinct(), "mix_copies")
    own = framed(docs, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"))
    joined = own.join(n, F.col("_id").eqNullSafe(F.col("_d")) & F.col("_t").eqNullSafe(F.col("_h"))).where("_n > 0")
    return (joined.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*unframed(docs.columns)))


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the language of labelled documents of good quality."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(good, "doc_id", "left_semi")
