"""Language identification by Bayesian evidence fusion.

Four pieces of evidence are multiplied: the likelihood of the text's character trigrams, the
language the markup or record declares, the language that the address suggests (a country
suffix or a language code as first path segment), and a prior of the host. Text models are
trained on all rows that declare a supported language. Host priors come from a grouped
aggregate of the languages that texts alone would get, smoothed hierarchically: a host's
counts lean on its parent domain's, those on their parent's, and so on up to the corpus.

Counts cover the whole corpus: tasks put out sums for at most ``BUCKETS`` trigram buckets per
language, so the models are of fixed size (languages x 16,384 numbers) whatever the input.
A background class with a flat model stands for everything that is no supported language;
a row is rejected if it wins, if no posterior reaches ``min_posterior``, or if the text has
no letters at all.

Defined results: a null or empty text is rejected (``und``). A null or unknown declared
language, a missing address and a null host are neutral evidence. Long texts are read whole;
their likelihood counts as at most ``EVIDENCE`` independent trigrams, since neighbouring
trigrams are not independent. Repeated rows give repeated results, empty tables an empty one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shield, small_batches, text_of, unshield

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BUCKETS = 1 << 14
ALPHA = 0.1          # added to every trigram count
EVIDENCE = 60        # trigrams that a text counts for at most
BACKGROUND = 0.01    # prior of the background class
DECLARED_RIGHT = 0.9
ADDRESS_RIGHT = 0.7
SMOOTHING = 10.0     # pseudo-counts that a host takes from its parent
MIN_POSTERIOR = 0.6
BROADCAST_HOSTS = 100_000  # rows of under 200 bytes


def trigram_buckets(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a lower-cased text; runs without letters are left out."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    code = np.where(letter, raw, np.uint8(32)).astype(np.uint32)
    tri = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    some = letter[:-2] | letter[1:-1] | letter[2:]
    return ((tri[some] * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def _count(languages):
    def run(batches):
        sums = {i: np.zeros(BUCKETS, np.int64) for i in range(len(languages))}
        for batch in batches:
            for declared, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[languages.index(declared)] += np.bincount(trigram_buckets(text.as_py()), minlength=BUCKETS)
        for i, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(s[at])], names=["lang", "bucket", "n"])

    return run


def train(docs: DataFrame, text_col: str, label_col: str, languages=LANGUAGES) -> np.ndarray:
    """Log-probabilities, one row per language, from all rows labelled with one of them."""
    rows = docs.select(F.lower(F.col(label_col)).alias("d"), text_of(text_col).alias("t")).filter(F.col("d").isin(*languages))
    counts = rows.mapInArrow(_count(list(languages)), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), BUCKETS), ALPHA)
    with small_batches(docs.sparkSession):
        for r in counts.toLocalIterator():  # at most languages x BUCKETS rows
            table[r["lang"], r["bucket"]] += r["n"]
    return np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(model: np.ndarray):
    """A pandas UDF: per language, then for the background, the tempered log-likelihood; null
    for a text without letters."""
    flat = -math.log(BUCKETS)

    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            b = trigram_buckets(t)
            if not len(b):
                out.append(None)
                continue
            weight = min(len(b), EVIDENCE)
            out.append([float(x) * weight for x in model[:, b].mean(axis=1)] + [flat * weight])
        return pd.Series(out)

    return evidence


def address_language(url_col: str, languages=LANGUAGES):
    """The language an address suggests: a language code as first path segment, or a country
    suffix equal to a language code; null if none."""
    rest = F.regexp_extract(F.col(url_col), r"://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1)
    suffix = F.regexp_extract(F.col(url_col), r"://[^/?#]*\.([A-Za-z]{2})(?::\d+)?(?:[/?#]|$)", 1)
    first = F.when(F.lower(rest).isin(*languages), F.lower(rest))
    return F.coalesce(first, F.when(F.lower(suffix).isin(*languages), F.lower(suffix)))


def ancestors(host):
    """A host and its parent domains, nearest first, then the corpus as a whole (empty name)."""
    parts = F.split(host, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.array_distinct(F.concat(tails, F.array(F.lit(""))))


def host_priors(texts: DataFrame, languages=LANGUAGES) -> DataFrame:
    """``host, prior`` (an array by language) from rows ``host, guess``.

    Counts are aggregated per host and language, then rolled up to every parent domain. Priors
    are filled in from the top: a domain's prior is its counts plus ``SMOOTHING`` pseudo-counts
    in its parent's proportions.
    """
    k = len(languages)
    # hosts without any guess go after the sums: a filter before them would be pushed below the guess
    # and have the texts judged twice, by two Python workers in each task
    counts = texts.groupBy("host").agg(
        *[F.sum((F.col("guess") == i).cast("long")).alias(f"n{i}") for i in range(k)]).filter("n0 IS NOT NULL")
    with small_batches(texts.sparkSession):
        counts = materialise(counts, "host_counts")
    up = counts.select(F.explode(ancestors(F.coalesce("host", F.lit("")))).alias("domain"), *[f"n{i}" for i in range(k)])
    domains = materialise(up.groupBy("domain").agg(F.array(*[F.sum(f"n{i}") for i in range(k)]).alias("n")), "domains")
    chains = counts.select("host", F.posexplode(ancestors(F.coalesce("host", F.lit(""))))).join(
        domains, F.col("col") == F.col("domain"))
    ordered = chains.groupBy("host").agg(F.reverse(F.sort_array(F.collect_list(F.struct("pos", "n")))).alias("chain"))  # labels of one name
    flat = F.array(*[F.lit(1.0 / k)] * k)
    prior = F.aggregate(
        F.transform("chain", lambda x: x["n"]), flat,
        lambda p, n: F.transform(F.zip_with(p, n, lambda a, b: F.lit(SMOOTHING) * a + b),
                                 lambda v: v / (F.aggregate(n, F.lit(0.0), lambda s, b: s + b) + SMOOTHING)))
    return materialise(ordered.select("host", prior.alias("prior")), "priors")


def identify(df: DataFrame, text_col: str = "text", declared_col: str | None = None, host_col: str | None = None,
             url_col: str | None = None, languages=LANGUAGES, min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """All columns of ``df`` plus ``_lang`` (``und`` if rejected), ``_posterior``, ``_accepted``
    and ``_text_lang`` (what the text alone says). ``host_col`` holds a host name; with
    ``url_col`` the host and the suggested language are taken from the address."""
    df, back = shield(df, *[c for c in (text_col, declared_col, host_col, url_col) if c])
    k = len(languages)
    host = F.lower(F.regexp_extract(F.col(url_col), r"://([^/?#:]*)", 1)) if url_col else (
        F.col(host_col).cast("string") if host_col else F.lit(None).cast("string"))
    declared = F.lower(F.substring(F.col(declared_col), 1, 2)) if declared_col else F.lit(None).cast("string")
    suggested = address_language(url_col, languages) if url_col else F.lit(None).cast("string")
    model = train(df.withColumn("_declared", declared), text_col, "_declared", languages) if declared_col else None
    if model is None:
        raise ValueError("text models are trained on a declared language; give declared_col")
    evidence = text_evidence(model)

    def guess(e):
        best = F.array_max(F.slice(e, 1, k))
        return F.when(best >= F.get(e, F.lit(k)), F.array_position(e, best).cast("int") - 1)

    seen = df.select(host.alias("host"), evidence(text_of(text_col)).alias("e"))
    priors = host_priors(seen.select("host", guess(F.col("e")).alias("guess")), languages)
    small = priors.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS  # checked; beyond it the join shuffles
    priors = priors.select(F.col("host").alias("_prior_host"), F.col("prior").alias("_prior"))

    rows = df.withColumn("_host", host).withColumn("_declared", declared).withColumn("_suggested", suggested).withColumn(
        "_e", evidence(text_of(text_col)))
    rows = rows.join(F.broadcast(priors) if small else priors, rows["_host"].eqNullSafe(priors["_prior_host"]), "left")

    def says(column, right):
        """Log-likelihood of one report given each language; neutral if it names none."""
        wrong = (1 - right) / max(1, k - 1)
        known = F.coalesce(column.isin(*languages), F.lit(False))
        return [F.when(~known, 0.0).when(column == l, math.log(right)).otherwise(math.log(wrong)) for l in languages] + [
            F.when(~known, 0.0).otherwise(math.log(1.0 / k))]

    d, s = says(F.col("_declared"), DECLARED_RIGHT), says(F.col("_suggested"), ADDRESS_RIGHT)
    prior = [F.log(F.coalesce(F.get("_prior", F.lit(i)), F.lit(1.0 / k)) * (1 - BACKGROUND)) for i in range(k)] + [F.lit(math.log(BACKGROUND))]
    logs = F.array(*[F.get("_e", F.lit(i)) + prior[i] + d[i] + s[i] for i in range(k + 1)])
    rows = rows.withColumn("_logs", logs).withColumn("_top", F.array_max("_logs"))
    total = F.aggregate("_logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_top")))
    rows = rows.withColumn("_posterior", F.when(F.col("_e").isNotNull(), 1.0 / total).otherwise(0.0))
    names = F.array(*[F.lit(l) for l in (*languages, UNKNOWN)])
    best = F.get(names, (F.array_position("_logs", F.col("_top")) - 1).cast("int"))
    taken = F.col("_e").isNotNull() & (best != UNKNOWN) & (F.col("_posterior") >= min_posterior)
    rows = rows.withColumn("_accepted", F.coalesce(taken, F.lit(False))).withColumn(
        "_lang", F.when(F.col("_accepted"), best).otherwise(UNKNOWN)).withColumn(
        "_text_lang", F.coalesce(F.get(names, guess(F.col("_e"))), F.lit(UNKNOWN)))
    return unshield(rows.select(*[F.col(f"`{c}`") for c in df.columns], "_lang", "_posterior", "_accepted", "_text_lang"), back)
