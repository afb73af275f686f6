"""Addresses judged by rules first and a character language-model ratio second.

Two smoothed variable-order Markov models (contexts of two, one and no characters,
interpolated by Witten-Bell weights) are trained on the addresses that the rules accept
and reject. An address without a rule is blocked if its length-normalised log-likelihood
under the rejected model exceeds that under the accepted one by more than a threshold
calibrated on the accepted addresses: at most ``false_block`` of them lie beyond it.

Native: DataFrame operations only. Characters fold to 42 symbols, so the model has at most
42^3 = 74,088 rows of 16 bytes, which bounds its broadcast at any input size; counts are
aggregated before every shuffle, so common hosts do not matter.

Defined results: a null address, or one without ``://``, has an empty host and path and no
rule, and is judged by the method on what there is of it. If either class has no training
address, the method allows. Repeated rows give repeated results. An empty table gives an
empty result. Other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = "*^$" + LETTERS + "0/:.-_?=&#%+~"
V = len(SYMBOLS)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_path(url):
    """Host and path columns of an address."""
    rest = F.expr("substring(_url, instr(_url, '://') + 3)") if url is None else url
    cut = F.when(F.instr(F.col("_url"), "://") > 0, rest).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(cut, r"^([^/?#]*)", 1), LETTERS.upper(), LETTERS)
    return host, F.regexp_extract(cut, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(rules):
    """The winning rule's text and verdict: the longest rule whose host equals or is a parent
    of the address's host and whose path starts the address's path."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text = F.when(fits, F.lit(host + path)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def folded(url):
    """The address in the model's symbols: lower case, digits as 0, others as ``*``, with two
    start marks and an end mark."""
    low = F.translate(F.translate(url, LETTERS.upper(), LETTERS), "123456789", "000000000")
    return F.concat(F.lit("^^"), F.regexp_replace(low, r"[^a-z0/:.\-_?=&#%+~]", "*"), F.lit("$"))


def trigrams(string: str):
    """The successive three-symbol strings of a folded address; ``string`` names a column that
    is already computed, since the function below reads it once per position."""
    return F.transform(F.sequence(F.lit(1), F.length(string) - 2), lambda i: F.col(string).substr(i, F.lit(3)))


def trigram_code(gram: str):
    """The number of a three-symbol string."""
    code = F.lit(0)
    for i in (1, 2, 3):
        code = code * V + F.instr(F.lit(SYMBOLS), F.substring(gram, i, 1)) - 1
    return code


def log_ratio_model(counts: DataFrame) -> DataFrame:
    """``code, weight`` for every three-symbol string: log p(rejected) - log p(accepted) of its
    last symbol given the two before. ``counts``: ``code, acc, rej``."""
    spark = counts.sparkSession
    c3 = counts.select("code", (F.col("code") % V).alias("c"), (F.col("code") % (V * V)).alias("bc"),
                       F.expr(f"code div {V}").alias("ab"), "acc", "rej")

    def sums(df, key, *kinds):
        return df.groupBy(key).agg(*[F.sum(k).cast("double").alias(f"{k}_{key}") for k in kinds],
                                   *[F.sum(F.when(F.col(k) > 0, 1).otherwise(0)).cast("double").alias(f"{k}_{key}_t") for k in kinds])

    two = c3.groupBy("bc").agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej")).withColumn("b", F.expr(f"bc div {V}")).withColumn("c", F.col("bc") % V)
    one = c3.groupBy("c").agg(F.sum("acc").alias("acc"), F.sum("rej").alias("rej"))
    total = one.agg(F.sum("acc").alias("acc_n"), F.sum("rej").alias("rej_n"))
    grid = spark.range(V ** 3).select(
        F.col("id").alias("code"), (F.col("id") % V).alias("c"), (F.col("id") % (V * V)).alias("bc"),
        F.expr(f"id div {V}").alias("ab"), F.expr(f"(id div {V}) % {V}").alias("b"))
    small = F.broadcast  # at most V^3 rows each
    g = (
        grid.join(small(c3.select("code", F.col("acc").alias("acc3"), F.col("rej").alias("rej3"))), "code", "left")
        .join(small(two.select("bc", F.col("acc").alias("acc2"), F.col("rej").alias("rej2"))), "bc", "left")
        .join(small(one.select("c", F.col("acc").alias("acc1"), F.col("rej").alias("rej1"))), "c", "left")
        .join(small(sums(c3, "ab", "acc", "rej")), "ab", "left")
        .join(small(sums(two, "b", "acc", "rej")), "b", "left")
        .withColumn("acc_n", total.select("acc_n").scalar()).withColumn("rej_n", total.select("rej_n").scalar())
        .na.fill(0)
    )

    def log_p(k):
        p0 = (F.col(f"{k}1") + 1.0) / (F.col(f"{k}_n") + float(V))
        n1, t1, n2, t2 = (F.col(f"{k}_{x}") for x in ("b", "b_t", "ab", "ab_t"))
        p1 = F.when(n1 + t1 > 0, (F.col(f"{k}2") + t1 * p0) / (n1 + t1)).otherwise(p0)
        p2 = F.when(n2 + t2 > 0, (F.col(f"{k}3") + t2 * p1) / (n2 + t2)).otherwise(p1)
        return F.ln(p2)

    return g.select("code", (log_p("rej") - log_p("acc")).alias("weight"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, false_block: float = 0.01) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``score``."""
    rows = (
        pages.select(F.col(id_col).alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
        .withColumn("_folded", folded(F.col("_url")))
        .groupBy("_id", "_url", "_folded").agg(F.count(F.lit(1)).alias("_times"))
    )
    host, path = host_path(None)
    rows = rows.select("*", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("said"))
    grams = rows.select("*", F.explode(trigrams("_folded")).alias("_gram"))
    counts = grams.filter("said is not null").groupBy("_gram").agg(
        F.sum(F.when(F.col("said") == "allow", F.col("_times")).otherwise(0)).alias("acc"),
        F.sum(F.when(F.col("said") == "block", F.col("_times")).otherwise(0)).alias("rej"))
    counts = materialise(counts.select(trigram_code("_gram").cast("long").alias("code"), "acc", "rej"), "counts")
    model = materialise(log_ratio_model(counts), "model")
    keys = ["_id", "_url", "_folded", "_times", "host", "path", "rule", "said"]
    coded = grams.withColumn("code", trigram_code("_gram").cast("long"))
    scored = materialise(
        coded.join(F.broadcast(model), "code").groupBy(*keys).agg(F.round(F.avg("weight"), 9).alias("score")), "scored")

    # the calibration histogram: steps of 0.001, so its size depends on the score's range alone
    bins = scored.filter("said is not null").groupBy(F.floor(F.col("score") * 1000).alias("bin")).agg(
        F.sum(F.when(F.col("said") == "allow", F.col("_times")).otherwise(0)).alias("acc"),
        F.sum(F.when(F.col("said") == "block", F.col("_times")).otherwise(0)).alias("rej"))
    steps = bins.agg(F.sort_array(F.collect_list(F.struct("bin", "acc", "rej"))).alias("s"))
    both = F.expr("aggregate(s, 0L, (a, x) -> a + x.acc) > 0 AND aggregate(s, 0L, (a, x) -> a + x.rej) > 0")
    # the lowest bin with at most the allowed share of accepted addresses above it
    above = F.expr(
        "transform(s, x -> struct(x.bin AS bin, aggregate(filter(s, y -> y.bin > x.bin), 0L, (a, y) -> a + y.acc) AS over))")
    limit = steps.select(F.when(both, F.expr("1")).alias("ok"), above.alias("o"), F.expr("aggregate(s, 0L, (a, x) -> a + x.acc)").alias("n")).select(
        F.when(F.col("ok") == 1, F.array_min(F.transform(F.filter("o", lambda x: x["over"] <= false_block * F.col("n")), lambda x: x["bin"]))).alias("bin"))
    out = scored.withColumn("_bin", limit.scalar())
    method = F.when(F.floor(F.col("score") * 1000) > F.col("_bin"), F.lit("block")).otherwise(F.lit("allow"))
    each = out.select("*", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_nth"))
    return each.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "score")


def oracle(rules=RULES, false_block: float = 0.01) -> str:
    """The same judgement as DuckDB SQL over ``pages``."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for h, p, _ in ranked]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, ranked)) + " END"
    said = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, ranked)) + " END"
    code = "0"
    for i in (0, 1, 2):
        code = f"(({code}) * {V} + instr('{SYMBOLS}', substring(folded, i + {i}, 1)) - 1)"

    def log_p(k):
        p0 = f"(coalesce({k}1, 0) + 1.0::DOUBLE) / ({k}_n + {float(V)})"
        p1 = f"CASE WHEN coalesce({k}_b, 0) > 0 THEN (coalesce({k}2, 0) + {k}_b_t * {p0}) / ({k}_b + {k}_b_t) ELSE {p0} END"
        return f"ln(CASE WHEN coalesce({k}_ab, 0) > 0 THEN (coalesce({k}3, 0) + {k}_ab_t * ({p1})) / ({k}_ab + {k}_ab_t) ELSE {p1} END)"

    def sums(key, source):
        return f"""SELECT {key}, sum(acc)::DOUBLE AS acc_{key}, sum(rej)::DOUBLE AS rej_{key},
          count(*) FILTER (acc > 0)::DOUBLE AS acc_{key}_t, count(*) FILTER (rej > 0)::DOUBLE AS rej_{key}_t FROM {source} GROUP BY 1"""

    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
c AS (SELECT *, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS cut,
  '^^' || regexp_replace(translate(translate(url, '{LETTERS.upper()}', '{LETTERS}'), '123456789', '000000000'),
    '[^a-z0/:.\\-_?=&#%+~]', '*', 'g') || '$' AS folded FROM u),
h AS (SELECT row_number() OVER () AS n, page_id, folded, translate(regexp_extract(cut, '^([^/?#]*)', 1), '{LETTERS.upper()}', '{LETTERS}') AS host,
  regexp_extract(cut, '^[^/?#]*([^?#]*)', 1) AS path FROM c),
r AS MATERIALIZED (SELECT *, {rule} AS rule, {said} AS said FROM h),
g AS MATERIALIZED (SELECT n, said, {code} AS code FROM (SELECT n, said, folded, unnest(range(1, length(folded) - 1)) AS i FROM r)),
k3 AS MATERIALIZED (SELECT code, code % {V} AS c, code % {V * V} AS bc, code // {V} AS ab,
  count(*) FILTER (said = 'allow') AS acc, count(*) FILTER (said = 'block') AS rej FROM g WHERE said IS NOT NULL GROUP BY 1, 2, 3, 4),
k2 AS (SELECT bc, bc // {V} AS b, bc % {V} AS c, sum(acc) AS acc, sum(rej) AS rej FROM k3 GROUP BY 1, 2, 3),
k1 AS (SELECT c, sum(acc) AS acc1, sum(rej) AS rej1 FROM k3 GROUP BY 1),
t AS (SELECT coalesce(sum(acc), 0) AS acc_n, coalesce(sum(rej), 0) AS rej_n FROM k3),
m AS (SELECT q.code, {log_p('rej')} - {log_p('acc')} AS weight FROM (SELECT DISTINCT code FROM g) q CROSS JOIN t
  LEFT JOIN (SELECT code, acc AS acc3, rej AS rej3 FROM k3) x3 ON x3.code = q.code
  LEFT JOIN (SELECT bc, acc AS acc2, rej AS rej2 FROM k2) x2 ON x2.bc = q.code % {V * V}
  LEFT JOIN k1 ON k1.c = q.code % {V}
  LEFT JOIN ({sums('ab', 'k3')}) sa ON sa.ab = q.code // {V}
  LEFT JOIN ({sums('b', 'k2')}) sb ON sb.b = (q.code // {V}) % {V}),
s AS (SELECT n, floor(round(avg(weight), 9) * 1000) AS bin FROM g JOIN m USING (code) GROUP BY n),
a AS (SELECT bin, count(*) FILTER (said = 'allow') AS acc, count(*) FILTER (said = 'block') AS rej FROM s JOIN r USING (n)
  WHERE said IS NOT NULL GROUP BY 1),
o AS (SELECT bin, sum(acc) OVER () AS all_acc, sum(rej) OVER () AS all_rej,
  sum(acc) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM a),
l AS (SELECT min(bin) AS bin FROM o WHERE all_acc > 0 AND all_rej > 0 AND all_acc - upto <= {false_block} * all_acc)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN s.bin > (SELECT bin FROM l) THEN 'block' ELSE 'allow' END) AS verdict
FROM r JOIN s USING (n)
"""
