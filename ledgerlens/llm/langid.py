"""Language of web pages by Bayesian fusion of text, declared markup language, address suffix and host."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import utf8
from ledgerlens.scratch import durable

# Labelled documents that the text model is fitted on (about; chosen by hash of the text).
TRAINING_DOCUMENTS = 4_000
BUCKETS = 1 << 14
# Trigrams of a text are no independent witnesses: together they count as this many at most.
WITNESSES = 40.0
# Pseudo-counts: of a trigram, of a declared language or suffix, of the level above a host.
SMOOTH_TEXT, SMOOTH_EVIDENCE, SMOOTH_HOST = 0.5, 1.0, 5.0

_RAW = re.compile(rb"<(script|style)\b", re.I)
_RAW_ENDS = {name: re.compile(rb"</" + name + rb"\s*>", re.I) for name in (b"script", b"style")}


def visible(data: bytes) -> bytes:
    """`data` with a space for each script, style, comment and tag, in one forward pass.

    What never closes is read as a tag, up to the next `>`; a kind of end that was searched for in vain
    is not searched for again.
    """
    out: list[bytes] = []
    at, missing = 0, set()
    while (p := data.find(b"<", at)) >= 0 and (end := data.find(b">", p) + 1):
        raw = _RAW.match(data, p)
        if raw and (name := raw[1].lower()) not in missing:
            close = _RAW_ENDS[name].search(data, raw.end())
            if close:
                end = close.end()
            else:
                missing.add(name)
        elif b"--" not in missing and data.startswith(b"<!--", p):
            close_at = data.find(b"-->", p + 4)
            if close_at >= 0:
                end = close_at + 3
            else:
                missing.add(b"--")
        out += [data[at:p], b" "]
        at = end
    return b"".join([*out, data[at:]])


def _trigrams(data: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of lower-cased text with white space as one space."""
    x = np.frombuffer(b" " + b" ".join(data.lower().split()) + b" ", np.uint8).astype(np.uint32)
    h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(18)
    return np.bincount(h, minlength=BUCKETS)


def fit_text(documents: DataFrame, size: int = TRAINING_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (languages x BUCKETS), from grouped counts over about `size` labelled texts."""
    known = documents.where("lang is not null and text is not null").select("lang", "text")
    n = known.count()
    share = min(1.0, size / n) if n else 1.0
    few = known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
    languages = sorted(r.lang for r in known.select("lang").distinct().collect())
    number = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                counts = _trigrams(data[offsets[i] : offsets[i + 1]].tobytes())
                totals[number[lang]] = totals.get(number[lang], 0) + counts
        for lang, counts in totals.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), lang)), pa.array(some), pa.array(counts[some])], names=["l", "bucket", "n"]
            )

    counts = np.full((max(1, len(languages)), BUCKETS), SMOOTH_TEXT)
    for r in few.mapInArrow(run, "l bigint, bucket bigint, n bigint").groupBy("l", "bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.l, r.bucket] += r.n
    return languages or ["und"], np.log(counts / counts.sum(axis=1, keepdims=True))


def text_evidence(pages: DataFrame, model: np.ndarray, id_col: str = "page_id") -> DataFrame:
    """(page_id, url, declared, ll): log-likelihood of the visible text in each language, at most WITNESSES strong."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^<>]*\slang\s*=\s*[\"']?([A-Za-z]+)", 1))
    source = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html")
    ).select("page_id", "url", F.nullif(declared, F.lit("")).alias("declared"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            found = []
            for i in range(batch.num_rows):
                counts = _trigrams(visible(data[offsets[i] : offsets[i + 1]].tobytes()))
                some = np.flatnonzero(counts)
                n = counts.sum()
                ll = model[:, some] @ counts[some] * min(1.0, WITNESSES / n)
                found.append((ll - ll.max()).tolist() if n > 2 else [0.0] * len(model))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.float64()))],
                names=["page_id", "url", "declared", "ll"],
            )

    return source.mapInArrow(run, "page_id bigint, url string, declared string, ll array<double>")


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    e = [F.exp(s - top) for s in scores]
    total = sum(e[1:], e[0])
    return [x / total for x in e]


def fuse(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Posterior over languages for each row of `text_evidence`, and what each kind of evidence was.

    Priors come from the posterior of the text alone, summed by host, by domain above it and over all pages;
    each level is smoothed by the one above, and a page does not count for its own host's prior. Declared
    language and suffix weigh by how often they are seen with each language.
    """
    n = range(len(languages))
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = evidence.withColumn("host", F.nullif(host, F.lit("")))
    parts = F.split("host", r"\.")
    rows = rows.withColumns(
        {"domain": F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), 2), "."),
         "suffix": F.element_at(parts, -1)}
    )
    post = _softmax([F.col("ll")[i] for i in n])
    rows = durable(rows.select("page_id", "host", "domain", "suffix", "declared", "ll", *[p.alias(f"t{i}") for i, p in enumerate(post)]))
    sums = [F.sum(f"t{i}").alias(f"s{i}") for i in n]
    overall = rows.agg(*[F.sum(f"t{i}") for i in n]).first()
    total = sum(x or 0.0 for x in overall)
    base = [((x or 0.0) + 1) / (total + len(languages)) for x in overall]
    domains = rows.groupBy("domain").agg(*sums)
    d_total = sum((F.col(f"s{i}") for i in n), F.lit(SMOOTH_HOST))
    domains = durable(domains.select("domain", *[((F.col(f"s{i}") + SMOOTH_HOST * base[i]) / d_total).alias(f"d{i}") for i in n]))
    hosts = durable(rows.groupBy("host", "domain").agg(*sums).join(domains, "domain", "left"))
    out = rows.join(hosts.drop("domain"), "host", "left")
    h_total = sum((F.col(f"s{i}") - F.col(f"t{i}") for i in n), F.lit(SMOOTH_HOST))
    prior = [
        F.coalesce((F.greatest(F.lit(0.0), F.col(f"s{i}") - F.col(f"t{i}")) + SMOOTH_HOST * F.col(f"d{i}")) / h_total, F.lit(base[i]))
        for i in n
    ]
    scores = [F.col("ll")[i] + F.log(prior[i]) for i in n]
    for name in ("declared", "suffix"):
        seen = rows.where(F.col(name).isNotNull()).groupBy(name).agg(*[F.sum(f"t{i}").alias(f"{name}{i}") for i in n])
        seen = durable(seen)
        kinds = seen.count()
        out = out.join(seen, name, "left")
        for i in n:
            p = (F.col(f"{name}{i}") + SMOOTH_EVIDENCE) / ((overall[i] or 0.0) + SMOOTH_EVIDENCE * max(1, kinds))
            scores[i] = scores[i] + F.coalesce(F.log(p), F.lit(0.0))
    final = _softmax(scores)
    best = F.greatest(*final) if len(final) > 1 else final[0]
    lang = F.coalesce(*[F.when(f == best, F.lit(languages[i])) for i, f in enumerate(final)])
    text_best = F.array_max("ll")
    text_lang = F.coalesce(*[F.when(F.col("ll")[i] == text_best, F.lit(languages[i])) for i in n])
    return out.select(
        "page_id", "host", "declared", "suffix", text_lang.alias("text_lang"), lang.alias("lang"),
        F.round(best, 6).alias("probability"),
    )


def identify(pages: DataFrame, documents: DataFrame, size: int = TRAINING_DOCUMENTS) -> DataFrame:
    """`page_id`, `host`, `declared`, `suffix`, `text_lang`, `lang`, `probability` of every page.

    The text model is fitted on about `size` documents with a language. Null or empty html has no text and no
    declaration, a null or odd URL no host and suffix: the other evidence and the overall shares decide, and
    equal scores go to the first language in alphabetical order. Rows repeat as pages do. Without labelled
    documents every page is "und".
    """
    languages, model = fit_text(documents, size)
    return fuse(text_evidence(pages, model), languages)
