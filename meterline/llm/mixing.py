"""Mixing documents to target weights of domains, with soft membership.

A table of labelled documents names the domain of some. A naive Bayes classifier over hashed word beginnings
and endings, counted in SQL on those, gives every document a posterior over the domains. Each document then gets a rate
r >= 0, the number of times it is to be used, such that the expected tokens of domain k, the sum of
r * tokens * p_k, match its target.

The rates start at ``START`` and are fitted by projected gradient steps on the least squares of the domain
totals. The residuals are weighted by the inverse of M = sum of tokens * p p', which makes the steps independent of the
sizes of the domains: r <- max(0, r + length * p . M^-1 (target - total)). A step needs only sums over the
table, one aggregation. The rate of a document is a fold of its posterior over the steps
so far, so no state is written between steps, and a lost executor costs nothing but its tasks.

Only SQL functions are used. The classifier is fitted on at most ``SAMPLE`` labelled rows, chosen by a hash of the
id (so they may be broadcast); all else covers every document. What reaches the driver: counts per hash bucket, and one
number per domain and step.

Null and empty texts have no tokens: their posterior is the prior and their rate cannot change a total (it follows the
same fold). Without labelled rows all domains are equally likely. A repeated id in the labels counts with its last domain; repeated
rows each get a rate; null ids are kept. An empty table gives no rows. New columns (n_tokens, rate, p_<domain>) replace columns
of the same name; all other columns are kept.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, stored, words_of

SAMPLE, BUCKETS, START = 20_000, 4096, 1.0
#: Most steps, the sum of gaps (as a share of all tokens) that ends them, and the lengths tried for each.
STEPS, ENOUGH, LENGTHS = 40, 1e-7, (1.0, 0.5, 0.2, 0.05)
#: Domains by the labels, in the order of their index, and their share of the tokens of the mixture.
DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.90, "low": 0.08, "toxic": 0.02}


def domain_of(labels: DataFrame) -> DataFrame:
    """doc_id and domain (index into DOMAINS) of labelled rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1))
    return known.select("doc_id", F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0).alias("domain"))


def _features(words: Column) -> Column:
    """Distinct buckets (from 1) of the beginnings and endings of the words."""
    bucket = lambda kind, x: F.pmod(F.xxhash64(F.lit(kind), x), F.lit(BUCKETS)) + 1
    return F.array_distinct(F.concat(F.transform(words, lambda w: bucket(0, F.left(w, F.lit(6)))), F.transform(words, lambda w: bucket(1, F.right(w, F.lit(3))))))


def described(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, n_tokens and f, the features, of every row."""
    kept = [c for c in keep if c not in ("n_tokens", "f")]
    rows = docs.select(*[col(c) for c in kept], words_of(F.lower("text")).alias("f"))
    rows = rows.select(*[col(c) for c in kept], F.size("f").cast("long").alias("n_tokens"), F.array_distinct("f").alias("f"))
    return rows.withColumn("f", _features(F.col("f")))


def likelihoods(docs: DataFrame, known: DataFrame, n_domains: int) -> tuple[list[float], list[list[float]]]:
    """Constant of each domain, and of each bucket its log-likelihood ratio to the mean of the domains."""
    sample = known.groupBy("doc_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = stored(described(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), ["domain"]))
    hits = lambda k: F.sum((F.col("domain") == k).cast("long")).alias(f"n{k}")
    counts = rows.select("domain", F.explode_outer("f").alias("b")).where("b is not null").groupBy("b").agg(*[hits(k) for k in range(n_domains)]).collect()
    sizes = sample.groupBy("domain").agg(F.count("*").alias("n")).collect()
    n = [0.0] * n_domains
    for r in sizes:
        n[r["domain"]] = float(r["n"])
    prior = [(x + 1) / (sum(n) + n_domains) for x in n]
    table = [[0.0] * BUCKETS for _ in range(n_domains)]
    for r in counts:
        told = [log((r[f"n{k}"] + 0.5) / (n[k] + 1)) for k in range(n_domains)]
        mean = sum(told) / n_domains
        for k in range(n_domains):
            table[k][r["b"] - 1] = told[k] - mean
    return fit_bias(stored(scored(rows, table).select("s")), prior), table


def scored(rows: DataFrame, table: list[list[float]]) -> DataFrame:
    """``rows`` with s, the evidence for each domain, in place of f.

    Features are not independent; their evidence is divided by the root of their number, which keeps memberships soft.
    """
    # one array of all domains, domain after domain, folded to a constant by the optimiser
    flat = F.split(F.lit(" ".join(f"{x:.4f}" for row in table for x in row)), " ").cast("array<double>")

    def score(k: int) -> Column:
        total = F.aggregate("f", F.lit(0.0), lambda acc, b: acc + F.element_at(flat, (b + k * BUCKETS).cast("int")))
        return total / F.sqrt(F.greatest(F.size("f"), F.lit(1)))

    return rows.withColumn("s", F.array(*[score(k) for k in range(len(table))])).drop("f")


def posteriors(bias: list[float]) -> Column:
    """Array of the probabilities of the domains."""
    return _softmax(F.zip_with("s", F.array(*[F.lit(x) for x in bias]), lambda x, y: x + y))


def fit_bias(rows: DataFrame, prior: list[float], rounds: int = 8) -> list[float]:
    """Constants of the domains for which the mean posterior of labelled rows is the share of each domain."""
    bias = [log(x) for x in prior]
    for _ in range(rounds):
        mean = rows.select(posteriors(bias).alias("p")).agg(*[F.avg(F.get("p", F.lit(k))) for k in range(len(prior))]).first()
        if mean[0] is None:
            break
        bias = [b + log(max(p, 1e-9) / max(m, 1e-9)) for b, p, m in zip(bias, prior, mean)]
    return bias


def _softmax(scores: Column) -> Column:
    raised = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def _solve(m: list[list[float]], v: list[float]) -> list[float]:
    """Solve a small symmetric system by elimination."""
    k = len(v)
    hold = 1e-9 * max(1.0, sum(m[i][i] for i in range(k)))
    rows = [[m[i][j] + (hold if i == j else 0.0) for j in range(k)] + [v[i]] for i in range(k)]
    for i in range(k):
        p = max(range(i, k), key=lambda r: abs(rows[r][i]))
        rows[i], rows[p] = rows[p], rows[i]
        for r in range(k):
            if r != i:
                q = rows[r][i] / rows[i][i]
                rows[r] = [a - q * b for a, b in zip(rows[r], rows[i])]
    return [rows[i][k] / rows[i][i] for i in range(k)]


def _rate(steps: list[list[float]], k: int) -> Column:
    """The rate after the steps so far."""
    if not steps:
        return F.lit(START)
    history = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])
    return F.aggregate(history, F.lit(START), lambda r, s: F.greatest(F.lit(0.0), r + sum(F.get("p", F.lit(i)) * F.get(s, F.lit(i)) for i in range(k))))


def fit_steps(state: DataFrame, targets: list[float]) -> tuple[list[list[float]], list[float], list[float]]:
    """Steps of the fit, the totals they reach and the totals aimed at; ``state`` has n_tokens and p.

    M is taken over the documents with a rate above zero, the ones a step can move both ways; of the lengths in
    ``LENGTHS`` the one that comes closest is taken, all tried in the same aggregation.
    """
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    p = [F.get("p", F.lit(i)) for i in range(k)]

    def told(rates: list[Column]) -> list[tuple[list[float], list[list[float]]]]:
        """Domain totals and M at each of the rates."""
        rows = state.withColumn("r", _rate(steps, k))
        rows = rows.select("n_tokens", *[x.alias(f"p{i}") for i, x in enumerate(p)], *[r.alias(f"r{a}") for a, r in enumerate(rates)])
        sums = []
        for a in range(len(rates)):
            r, n = F.col(f"r{a}"), F.col("n_tokens")
            sums += [F.sum(n * r * F.col(f"p{i}")) for i in range(k)]
            sums += [F.sum(F.when(r > 0, n * F.col(f"p{i}") * F.col(f"p{j}")).otherwise(0.0)) for i, j in pairs]
        got = [float(x or 0) for x in rows.agg(*[s.alias(f"s{c}") for c, s in enumerate(sums)]).first()]
        out = []
        for a in range(len(rates)):
            part = got[a * (k + len(pairs)) :]
            m = [[0.0] * k for _ in range(k)]
            for (i, j), x in zip(pairs, part[k:]):
                m[i][j] = m[j][i] = x
            out.append((part[:k], m))
        return out

    steps: list[list[float]] = []
    tokens = float(state.agg(F.sum("n_tokens")).first()[0] or 0)
    goal = [t * tokens / sum(targets) for t in targets]
    if not tokens:
        return [], [0.0] * k, goal
    far = lambda total: sum(abs(g - t) for g, t in zip(goal, total))
    [(total, m)] = told([F.col("r")])
    while len(steps) < STEPS and far(total) > ENOUGH * tokens:
        step = _solve(m, [g - t for g, t in zip(goal, total)])
        move = sum(x * F.lit(y) for x, y in zip(p, step))
        tried = told([F.greatest(F.lit(0.0), F.col("r") + F.lit(length) * move) for length in LENGTHS])
        best = min(range(len(LENGTHS)), key=lambda a: far(tried[a][0]))
        if far(tried[best][0]) >= far(total):
            break  # targets out of reach for rates that are not negative
        total, m = tried[best]
        steps.append([LENGTHS[best] * x for x in step])
    return steps, total, goal


def mix(docs: DataFrame, known: DataFrame, targets: dict[str, float], keep: list[str]) -> DataFrame:
    """Columns ``keep``, n_tokens, p_<domain> of each domain, and rate. ``known``: doc_id, domain (index into targets)."""
    names = list(targets)
    bias, table = likelihoods(docs, known, len(names))
    made = {"n_tokens", "rate", *(f"p_{n}" for n in names)}
    kept = [c for c in keep if c.lower() not in made]
    inside = [f"c{i}" for i in range(len(kept))]  # names of their own inside, which clash with nothing
    rows = docs.select(*[col(c).alias(n) for c, n in zip(kept, inside)], "text")
    state = stored(scored(described(rows, inside), table).withColumn("p", posteriors(bias)).drop("s"))
    steps, _, _ = fit_steps(state.select("n_tokens", "p"), [targets[n] for n in names])
    found = [F.get("p", F.lit(i)).alias(f"p_{n}") for i, n in enumerate(names)]
    out = state.select(*inside, "n_tokens", *found, _rate(steps, len(names)).alias("rate"))
    return out.toDF(*kept, *out.columns[len(kept):])
