"""Language identification: multinomial naive Bayes over hashed character n-grams, scored in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import pieces

LONGEST = 4
BUCKET_BITS = 16
SMOOTHING = 0.1
UNKNOWN = "und"
#: Code points that are scored at once.
SPAN = 1 << 20
#: The share of the training rows below which a fit is too poor, and what a text of one letter may stay below that.
POOR_SHARE, SLACK = 0.001, 9.0

_letter = np.zeros(0, np.uint32)


def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter, else the blank. Built once in each worker."""
    global _letter
    if not len(_letter):
        _letter = np.fromiter((i if chr(i).isalpha() else 32 for i in range(0x110000)), np.uint32, 0x110000)
    return _letter


def _spans(texts: list[str | None]):
    """(document, code points, starts) in runs of about SPAN n-gram starts; a long text spreads over several runs.

    Each text gets a blank in front and behind. A cut text repeats its next LONGEST - 1 code points, so each n-gram
    starts in exactly one run.
    """
    table = _letters()
    docs, parts, room = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        points = table[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
        # Runs of blanks say no more than one.
        points = points[np.r_[True, (points[1:] != 32) | (points[:-1] != 32)]]
        for at in range(0, len(points), SPAN):
            part = points[at : at + SPAN + LONGEST - 1]
            docs.append((i, min(SPAN, len(points) - at)))
            parts.append(np.r_[part, np.zeros(LONGEST, np.uint32)])
            room += len(part)
            if room >= SPAN:
                yield docs, parts
                docs, parts, room = [], [], 0
    if docs:
        yield docs, parts


def _features(docs: list[tuple[int, int]], parts: list[np.ndarray]):
    """(documents, buckets) of all n-grams of a run, one pair of arrays for each length."""
    points = np.concatenate(parts).astype(np.uint64)
    lengths = np.array([len(p) for p in parts])
    owner = np.repeat(np.array([d for d, _ in docs]), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    starts = np.arange(len(points)) - first < np.repeat(np.array([n for _, n in docs]), lengths)
    value = np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST + 1):
        last = np.r_[points[n - 1 :], np.zeros(n - 1, np.uint64)]
        value = value * np.uint64(0x100000001B3) + last
        fits = starts & (last > 0)
        if n == 1:
            fits &= last != 32
        mixed = (value ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        yield owner[fits], (mixed[fits] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class LanguageModel:
    """Log probabilities, buckets x languages, and log shares of the languages."""

    languages: list[str]
    log_probability: np.ndarray
    log_prior: np.ndarray


def _teaching(labelled: DataFrame, text_column: str, label_column: str, training_rows: int | None) -> tuple[DataFrame, dict[str, int]]:
    """The labelled rows that teach, and the number of all labelled rows of each language."""
    rows = labelled.select(F.col(text_column).alias("text"), F.col(label_column).alias("lang")).filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    thin = None
    for name in sorted(sizes):
        if training_rows is not None and sizes[name] > training_rows:
            keep = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(training_rows / sizes[name] * (1 << 20))
            thin = (F.col("lang") != name) | keep if thin is None else thin & ((F.col("lang") != name) | keep)
    if thin is not None:
        rows = rows.filter(thin)
    return rows, sizes


def train(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", training_rows: int | None = None) -> LanguageModel:
    """Count n-grams per language in all labelled rows; ``training_rows`` thins them to about so many of each language.

    Rows without text or label teach nothing. Tasks count in numpy and send (language, bucket, count) triples that
    Spark adds up; the driver receives the sums, at most languages * 2 ** BUCKET_BITS of them.
    """
    rows, sizes = _teaching(labelled, text_column, label_column, training_rows)
    languages = sorted(sizes)
    number = {x: i for i, x in enumerate(languages)}

    def count(batches):
        sums = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            of = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for start, texts in pieces(batch, "text"):
                for docs, parts in _spans(texts):
                    for owner, bucket in _features(docs, parts):
                        found = np.bincount((of[owner + start] << BUCKET_BITS) + bucket, minlength=sums.size)
                        sums += found.reshape(sums.shape)
        at = np.flatnonzero(sums)
        for i in range(0, len(at), 1 << 16):
            part = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums.ravel()[part])], ["at", "n"])

    log_probability = np.zeros((1 << BUCKET_BITS, len(languages)))
    if languages:
        sums = rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros(len(languages) << BUCKET_BITS)
        table[sums["at"].to_numpy()] = sums["n"].to_numpy()
        table = table.reshape(len(languages), -1) + SMOOTHING
        log_probability = np.log(table / table.sum(axis=1, keepdims=True)).T
    total = sum(sizes.values())
    prior = np.log(np.array([sizes[x] / total for x in languages]) if languages else np.ones(0))
    return LanguageModel(languages, np.ascontiguousarray(log_probability, np.float32), prior)


def score(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its posterior probability; ``und`` and 0 without a letter."""
    return judge(texts, model)[:2]


def judge(texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """What ``score`` gives, the mean log probability per n-gram in the best language, and the number of letters."""
    sums = np.zeros((len(texts), len(model.languages)))
    letters, grams = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for docs, parts in _spans(texts):
        for n, (owner, bucket) in enumerate(_features(docs, parts), 1):
            if n == 1:
                letters += np.bincount(owner, minlength=len(texts))
            grams += np.bincount(owner, minlength=len(texts))
            if len(owner):
                cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                part = np.add.reduceat(model.log_probability[bucket], cut, axis=0, dtype=np.float64)
                np.add.at(sums, owner[cut], part)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), letters
    plain, sums = sums, sums + model.log_prior
    best = sums.argmax(axis=1)
    fit = plain[np.arange(len(texts)), best] / np.maximum(grams, 1)
    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    known = letters > 0
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, share, 0.0), fit, letters


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", carry: list[str] = (), with_fit: bool = False) -> DataFrame:
    """The columns ``carry``, then ``lang_pred`` and ``score`` (posterior, 0 to 1), for each row.

    Null texts and texts without a letter get ``und`` and 0, as all texts do if the model knows no language. Ties go
    to the language that sorts first. Long texts are scored whole, in spans. The model is broadcast: its size is set
    by the number of buckets and languages, not by the data. ``with_fit`` adds ``fit`` and ``letters`` of ``judge``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # The text travels once and drops out again unless it is carried.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.lit(True).alias("_some")).alias("carried"), F.col(text_column).alias("text"))

    def run(batches):
        for batch in batches:
            names, shares, fits, letters = [], [], [], []
            for _, texts in pieces(batch, "text"):
                found, *rest = judge(texts, shared.value)
                names += found
                for own, part in zip((shares, fits, letters), rest):
                    own.append(part)
            columns = [batch.column(0), pa.array(names, pa.string()), *[pa.array(np.concatenate(x)) for x in (shares, fits, letters)]]
            yield pa.RecordBatch.from_arrays(columns, ["carried", "lang_pred", "score", "fit", "letters"])

    kind = rows.schema["carried"].dataType.simpleString()
    out = rows.mapInArrow(run, f"carried {kind}, lang_pred string, score double, fit double, letters long")
    return out.select(*[F.col(f"carried.`{c}`").alias(c) for c in carry], "lang_pred", "score", *(["fit", "letters"] if with_fit else []))


def least_fits(judged: DataFrame, label: Column) -> dict[str, float]:
    """For each language the fit that all but POOR_SHARE of its labelled rows reach, of those recognised as it.

    ``judged`` is what ``identify`` gives ``with_fit``; all its rows count whose ``label`` is the language found.
    """
    found = judged.filter(label == F.col("lang_pred"))
    return {r["lang_pred"]: r["low"] for r in found.groupBy("lang_pred").agg(F.percentile_approx("fit", POOR_SHARE, 10_000).alias("low")).collect()}


def fits(low: dict[str, float]) -> Column:
    """Whether ``fit`` reaches the limit of ``lang_pred``, less by SLACK over the root of the number of letters.

    The mean of few n-grams scatters, hence the slack. A language without a limit takes all.
    """
    limit = F.lit(None).cast("double")
    for name, value in low.items():
        limit = F.when(F.col("lang_pred") == name, F.lit(value)).otherwise(limit)
    return F.coalesce(F.col("fit") >= limit - SLACK / F.sqrt("letters"), F.lit(True))
