"""Seams for media models. A model is anything that maps a batch of inputs to outputs of a
fixed schema; it is loaded once per Python worker and called on Arrow batches. Deterministic
stand-ins serve tests. No weights are part of this package."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.functions import vectors


class Encoder(Protocol):
    """Texts or pictures to vectors."""

    def encode(self, items: list[object]) -> np.ndarray: ...


class Detector(Protocol):
    """A picture to rows of boxes."""

    def detect(self, item: object) -> list[dict]: ...


class TextReader(Protocol):
    """A picture to recognized texts: text, confidence and a box of pixels each."""

    def read(self, item: object) -> list[dict]: ...


class SpeechReader(Protocol):
    """A stretch of sound to segments: start_ms, end_ms and text each."""

    def transcribe(self, item: object) -> list[dict]: ...


class Captioner(Protocol):
    """Pictures and an instruction to one answer."""

    def describe(self, items: list[object], instruction: str) -> str: ...


class ShotScorer(Protocol):
    """A window of small frames to one transition score per frame."""

    def scores(self, frames: np.ndarray) -> np.ndarray: ...


class FallbackEncoder:
    """The first encoder; for a batch on which it raises, the second. Memory errors are passed on, as batches are halved for them."""

    def __init__(self, first: Encoder, second: Encoder):
        self.first, self.second = first, second

    def encode(self, items: list[object]) -> np.ndarray:
        try:
            return self.first.encode(items)
        except MemoryError:
            raise
        except Exception:  # whatever the model raises
            return self.second.encode(items)


def map_rows(df: DataFrame, column: str, factory: Callable[[], object], method: str, schema: str, *, key: str, **arguments: object) -> DataFrame:
    """One row per result of ``method`` (a list of dicts) on each input: readers of text or speech, or any callable of that form."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = getattr(factory(), method)
        for b in batches:
            rows = [{key: k, **d} for k, x in zip(b[key], b[column]) for d in call(x, **arguments)]
            yield pd.DataFrame(rows, columns=names)

    return df.where(F.col(column).isNotNull()).select(key, column).mapInPandas(run, schema)


class HashEncoder:
    """A stand-in: unit vectors drawn from a hash of the input."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def encode(self, items: list[object]) -> np.ndarray:
        out = np.empty((len(items), self.dim), np.float32)
        for i, x in enumerate(items):
            seed = int.from_bytes(hashlib.sha256(str(x).encode()).digest()[:8], "little")
            v = np.random.default_rng(seed).normal(size=self.dim)
            out[i] = v / np.linalg.norm(v)
        return out


def encode_column(df: DataFrame, column: str, factory: Callable[[], Encoder], *, key: str, batch: int = 256, output: str = "vector") -> DataFrame:
    """(key, output): each distinct input is encoded once; a batch that does not fit in memory is halved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()

        def attempt(items: list[object]) -> np.ndarray:
            try:
                return model.encode(items)
            except MemoryError:
                if len(items) == 1:
                    raise
                half = len(items) // 2
                return np.concatenate([attempt(items[:half]), attempt(items[half:])])

        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                yield pd.DataFrame({"_in": part["_in"].to_numpy(), output: list(attempt(part["_in"].tolist()))})

    kind = dict(df.dtypes)[column]
    todo = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_in")).distinct()
    made = todo.mapInPandas(run, f"_in {kind}, {output} array<float>")
    return df.select(key, F.col(column).alias("_in")).join(made, "_in").select(key, output)


def detect_rows(df: DataFrame, column: str, factory: Callable[[], Detector], schema: str, *, key: str) -> DataFrame:
    """One row per detection; the filter on wanted rows belongs before this call."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for b in batches:
            rows = [{key: k, **d} for k, x in zip(b[key], b[column]) for d in model.detect(x)]
            yield pd.DataFrame(rows, columns=names)

    return df.select(key, column).mapInPandas(run, schema)


def unit_rows(encoded: DataFrame, vector: str = "vector") -> DataFrame:
    return encoded.withColumn(vector, vectors.normalize(F.col(vector)).cast("array<float>"))
