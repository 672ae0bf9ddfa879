"""Language of web pages by Bayesian fusion of evidence.

For every page and language: the likelihood of the visible text (letter trigrams), of
the language that the markup declares, and of the address suffix, times a prior of the
page's host.  Host priors are smoothed towards the other hosts of the domain and those
towards all pages; all counts are grouped sums over all pages of the posteriors that
the text alone gives.  Each level leaves out what the level below already holds, the
page itself included, so no page votes for itself twice.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Written

BUCKETS = 1 << 15
SAMPLE = 20_000
#: Trigrams of a text count as at most so many independent ones.
INDEPENDENT = 40.0
SMOOTHING = 5.0
_HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>")


def visible_text(page: str | None) -> str:
    return html.unescape(_HIDDEN.sub(" ", page or ""))


def trigrams(text: str | None) -> np.ndarray:
    """Hash buckets of the letter trigrams of a text in lower case, in order."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (codes >= 97) & (codes <= 122) | (codes > 170)
    codes = np.where(letter, codes, 32)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    a, b, c = codes[:-2].astype(np.int64), codes[1:-1].astype(np.int64), codes[2:].astype(np.int64)
    found = ((a * 1_000_003 + b) * 1_000_003 + c) % 2_147_483_647 % BUCKETS
    return found[(b != 32)]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            total = np.zeros(BUCKETS, np.int64)
            for text in texts:
                total += np.bincount(trigrams(text), minlength=BUCKETS)
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": total[used]})


def train(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities of trigram buckets, ``(languages, BUCKETS)``.

    Learned from at most ``sample`` labelled documents, the first in hash order; whole
    texts.  Only bucket counts reach the driver.
    """
    labelled = docs.where("lang IS NOT NULL AND lang != '' AND text IS NOT NULL")
    order = F.xxhash64("doc_id", "lang")
    picked = labelled.select("doc_id", "lang").orderBy(order, "doc_id", "lang").limit(sample)
    # At most ``sample`` ids.
    chosen = labelled.select("doc_id", "lang", "text").join(
        F.broadcast(picked.distinct()), ["doc_id", "lang"]
    )
    counted = chosen.select("lang", "text").mapInPandas(_counted, "lang string, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.full((len(languages), BUCKETS), 0.5)
    numbers = rows["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=int)
    counts[numbers, rows["bucket"].to_numpy(dtype=int)] += rows["n"].to_numpy(dtype=float)
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def text_evidence(pages: DataFrame, table: np.ndarray) -> DataFrame:
    """``pages`` with ``evidence``, the log-likelihood of the visible text per language."""
    shared = pages.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("array<double>")
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        logs = shared.value
        for batch in texts:
            out = []
            for page in batch:
                found = trigrams(visible_text(page))
                counts = np.bincount(found, minlength=BUCKETS) if len(found) else np.zeros(BUCKETS)
                weight = min(1.0, INDEPENDENT / len(found)) if len(found) else 0.0
                out.append(weight * (logs @ counts))
            yield pd.Series(out)

    return pages.withColumn("evidence", evidence(F.col("html")))


def _address(url: Column) -> list[Column]:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.nullif(F.regexp_replace(host, r"^www\.|\.+$", ""), F.lit(""))
    domain = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    suffix = F.regexp_extract(host, r"\.([^.]+)$", 1)
    return [
        host.alias("host"),
        F.coalesce(F.nullif(domain, F.lit("")), host).alias("domain"),
        F.nullif(suffix, F.lit("")).alias("suffix"),
    ]


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(rows: DataFrame, keys: list[str], values: str, n: int) -> DataFrame:
    """Element-wise sums of an array column by group, and the number of rows."""
    parts = [F.sum(F.col(values)[i]).alias(f"s{i}") for i in range(n)]
    summed = rows.groupBy(*keys).agg(F.count("*").alias("n"), *parts)
    return summed.select(*keys, "n", F.array(*[F.col(f"s{i}") for i in range(n)]).alias("c"))


def _smoothed(counts: Column, total: Column, parent: Column) -> Column:
    return F.zip_with(
        counts, parent, lambda c, p: (F.greatest(c, F.lit(0.0)) + SMOOTHING * p) / (total + SMOOTHING)
    )


def _minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def _declared(markup: Column, languages: list[str]) -> Column:
    """The declared language, ``other`` for one that is not known, ``none`` for none."""
    tag = F.lower(F.regexp_extract(markup, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    return F.when(F.coalesce(tag, F.lit("")) == "", F.lit("none")).otherwise(
        F.when(tag.isin(*languages), tag).otherwise(F.lit("other"))
    )


def identify(pages: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """``(page_id, lang, probability, text_lang, declared, host)``, one row for each page.

    Null or empty markup and unreadable addresses are no evidence; what is left decides.
    Ties go to the language that comes first in the alphabet.  Without languages
    (nothing to train on) ``lang`` is null.  Repeated rows and null page ids are
    pages of their own.  Columns besides page_id, url and html are not looked at.
    """
    if not languages:
        return pages.select(
            "page_id",
            F.lit(None).cast("string").alias("lang"),
            F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("text_lang"),
            F.lit("none").alias("declared"),
            _address(F.col("url"))[0],
        )
    n = len(languages)
    names = F.array(*[F.lit(lang) for lang in languages])
    read = text_evidence(pages.select("page_id", "url", "html"), table).select(
        "page_id", *_address(F.col("url")), _declared(F.col("html"), languages).alias("declared"), "evidence"
    )
    read = read.select("*", _softmax(F.col("evidence")).alias("q"))
    read = Written(read, "page-evidence").df
    by_declared = {r["declared"]: r["c"] for r in _sums(read, ["declared"], "q", n).collect()}
    total = np.array(list(by_declared.values()) or [[0.0] * n]).sum(axis=0)
    overall = (total + 1.0) / (total + 1.0).sum()
    seen = [*languages, "other", "none"]
    trust = {
        d: np.log((np.array(by_declared.get(d, [0.0] * n)) + 1.0) / (total + len(seen))) for d in seen
    }
    hosts = Written(_sums(read.where("host IS NOT NULL"), ["host", "domain", "suffix"], "q", n), "hosts").df
    priors = _host_priors(hosts, overall, n)
    joined = read.join(priors, "host", "left")
    flat = F.array(*[F.lit(float(p)) for p in overall])
    prior = F.when(
        F.col("c").isNotNull(),
        _smoothed(_minus(F.col("c"), F.col("q")), F.col("n") - 1, F.col("parent")),
    ).otherwise(flat)
    said = F.create_map(
        *[x for d in seen for x in (F.lit(d), F.array(*[F.lit(float(v)) for v in trust[d]]))]
    )[F.col("declared")]
    nothing = F.array(*[F.lit(0.0)] * n)
    log = F.zip_with(
        F.zip_with("evidence", said, lambda a, b: a + b),
        F.zip_with(F.transform(prior, lambda x: F.log(x)), F.coalesce("suffix_log", nothing), lambda a, b: a + b),
        lambda a, b: a + b,
    )
    posterior = joined.select("page_id", "host", "declared", "q", F.explode(F.array(_softmax(log))).alias("p"))
    best = F.array_max("p")
    return posterior.select(
        "page_id",
        names[F.array_position("p", best).cast("int") - 1].alias("lang"),
        best.alias("probability"),
        names[F.array_position("q", F.array_max("q")).cast("int") - 1].alias("text_lang"),
        "declared",
        "host",
    )


def _host_priors(hosts: DataFrame, overall: np.ndarray, n: int) -> DataFrame:
    """``(host, n, c, parent, suffix_log)`` of each host."""

    def level(key: str, name: str) -> DataFrame:
        parts = [F.sum(F.col("c")[i]).alias(f"s{i}") for i in range(n)]
        summed = hosts.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias(f"{name}_n"), *parts)
        return summed.select(key, f"{name}_n", F.array(*[F.col(f"s{i}") for i in range(n)]).alias(f"{name}_c"))

    flat = F.array(*[F.lit(float(p)) for p in overall])
    joined = hosts.join(level("domain", "d"), "domain").join(level("suffix", "x"), "suffix", "left")
    parent = _smoothed(_minus(F.col("d_c"), F.col("c")), F.col("d_n") - F.col("n"), flat)
    # How much likelier the suffix is under a language than over all, from other domains.
    of_suffix = _smoothed(_minus(F.col("x_c"), F.col("d_c")), F.col("x_n") - F.col("d_n"), flat)
    suffix_log = F.zip_with(of_suffix, flat, lambda s, p: F.log(s / p))
    return joined.select(
        "host", "n", "c", parent.alias("parent"), F.when(F.col("x_c").isNotNull(), suffix_log).alias("suffix_log")
    )
