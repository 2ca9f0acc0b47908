"""Periodic runs of words by heavy/light lag counting.

A run repeats its first words at least four times over. At its period, as a lag, every word but the first ones equals
the word a lag before, so a lag can hold a run only if enough pairs of equal words lie that far apart. Those pairs are
counted exactly for every lag at once: frequent words by the autocorrelation of their places (one FFT over all of them,
rounded to integers), rare words by the differences of their places. Lags with enough matches get an island scan, which
finds the maximal stretches of matches. Matches that runs of shorter periods explain are taken off the counts of the
multiples of their periods, and before a scan two neighbouring blocks of a lag's length must agree at a few probes, so
that texts of one word, or of two, stay cheap. Documents are independent: the plan is a scan and a map, no shuffle.

Defined results: a null or empty text has no words, no runs, and an empty collapsed text; a null id stays null, and its
row gives a row as any other; rows that repeat an id are taken one by one; texts of any length are taken whole; other
columns, whatever their names, play no part; an empty table gives an empty result. A stretch that several periods fit is
a run of the smallest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The least number of words of a run, and of its periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words that occur more often than this, and than the square root of n log n, are counted by FFT.
LEAST_HEAVY = 16
#: Entries of a block of indicator rows that are transformed at once, and of a block of differences.
SLAB = 1 << 22
PROBES = 16
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def lag_matches(codes: np.ndarray, most: int) -> np.ndarray:
    """How many pairs of equal words lie each lag up to most apart; entry 0 means nothing."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    sizes = np.bincount(codes)
    heavy = max(LEAST_HEAVY, int((n * max(1, n.bit_length())) ** 0.5))
    found = np.zeros(most + 1, np.int64)
    # rare words: the k-th next place of the same word, for as long as one is near enough
    light = sizes[codes[order]] <= heavy
    place = order[light]
    word = codes[place]
    at, k = np.arange(len(place)), 1
    while len(at):
        at = at[at + k < len(place)]
        gap = place[np.minimum(at + k, len(place) - 1)] - place[at]
        near = (word[np.minimum(at + k, len(place) - 1)] == word[at]) & (gap <= most)
        at = at[near]
        found += np.bincount(gap[near], minlength=most + 1)
        k += 1
    # frequent words: the sum of their autocorrelations is one inverse transform of the sum of their spectra
    often = np.flatnonzero(sizes > heavy)
    if len(often):
        width = 1 << (n + most).bit_length()
        rows = max(1, SLAB // width)
        power = np.zeros(width // 2 + 1)
        number = np.full(len(sizes), -1)
        number[often] = np.arange(len(often))
        which = number[codes]
        for a in range(0, len(often), rows):
            mine = np.flatnonzero((which >= a) & (which < a + rows))
            marks = np.zeros((min(rows, len(often) - a), width))
            marks[which[mine] - a, mine] = 1.0
            power += (np.abs(np.fft.rfft(marks)) ** 2).sum(0)
        found += np.rint(np.fft.irfft(power, width)[: most + 1]).astype(np.int64)
    return found


def _hopeful(codes: np.ndarray, lag: int) -> bool:
    """Whether two neighbouring blocks at multiples of the lag may match throughout, as any island of three lags holds."""
    block = np.arange(0, len(codes) - 3 * lag + 1, lag)
    for offset in {2 * lag * i // PROBES for i in range(PROBES)}:
        block = block[codes[block + offset] == codes[block + offset + lag]]
    return len(block) > 0


def runs_of(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start and period; codes number the words from 0."""
    n = len(codes)
    most = n // LEAST_PERIODS
    if n < LEAST_WORDS:
        return []
    lags = np.arange(most + 1)
    need = np.maximum(LEAST_WORDS - lags, (LEAST_PERIODS - 1) * lags)
    left = lag_matches(codes, most)
    left[0] = -1
    runs, known = [], set()
    for lag in np.flatnonzero(left >= need).tolist():
        if left[lag] < need[lag] or (lag >= PROBES and not _hopeful(codes, lag)):
            continue
        same = np.zeros(n - lag + 2, np.int8)
        same[1:-1] = codes[lag:] == codes[:-lag]
        turns = np.flatnonzero(np.diff(same))
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            # a stretch of a smaller period p has been found at p, for which p divides this lag
            size = end - start + lag
            if end - start >= need[lag] and (start, size) not in known:
                known.add((start, size))
                runs.append((start, size, lag))
                multiples = np.arange(lag, min(size, most + 1), lag)
                left[multiples] -= size - multiples
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def periodic_runs(docs: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs and collapsed (the words that no run repeats, joined by one space) of each row of docs (doc_id, text).

    prepare: changes a row's words before the search, given its id.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, texts = [], [], []
            for i, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                words = body.split() if body else []
                if prepare and words:
                    words = prepare(i, words)
                mine = runs_of(_numbered(words))
                gone = np.zeros(len(words) + 1, np.int64)
                for start, size, period in mine:
                    gone[start + period] += 1
                    gone[start + size] -= 1
                lost = np.cumsum(gone[:-1]) > 0
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
                texts.append(b" ".join([w for w, x in zip(words, lost.tolist(), strict=True) if not x] if mine else words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body")).mapInArrow(find, SCHEMA)


def summary(found: DataFrame) -> DataFrame:
    """One row of numbers and digests for each row of periodic_runs: the longest run (ties: the first, then the shortest period) and all."""

    def line(r: Column) -> Column:
        return F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))

    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer"))))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.finer")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.finer")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
