"""Models behind interfaces: chat and embedding providers, called in batches on the executors, each prompt once per batch.

Live providers take their credentials from the environment of the executors. The offline ones are deterministic, for
tests and for queries that must repeat.
"""

from __future__ import annotations

import hashlib
import time
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.functions.arrow import appended


class ChatProvider(Protocol):
    def complete(self, prompts: list[str]) -> list[str]: ...


class EmbeddingProvider(Protocol):
    dim: int

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class FetchProvider(Protocol):
    def fetch(self, urls: list[str]) -> list[tuple[int, bytes]]: ...


class EchoChat:
    """Answers with the last line of the prompt that isn't blank, or a fixed answer where the prompt has a given phrase."""

    def __init__(self, answers: dict[str, str] | None = None):
        self.answers = answers or {}

    def complete(self, prompts: list[str]) -> list[str]:
        lines = lambda p: [x for x in p.splitlines() if x.strip()] or [""]
        return [next((a for k, a in self.answers.items() if k in p), lines(p)[-1].strip()) for p in prompts]


class PassageChat:
    """Answers from the passages of the prompt, always alike: a rewritten query is the query, passages of an odd length name
    an organization and the others answer N/A, any other question is answered with the first line."""

    def complete(self, prompts: list[str]) -> list[str]:
        return [self._one(p) for p in prompts]

    @staticmethod
    def _one(prompt: str) -> str:
        if prompt.endswith("\nNew query:"):
            return prompt.rpartition("\n\nQuery: ")[2].removesuffix("\nNew query:")
        passages, _, question = prompt.partition("Passages:\n")[2].rpartition("\n\nQuestion: ")
        if question.startswith("Name the organization"):
            return f"Organization {len(passages)}" if len(passages) % 2 else "N/A"
        return next((x.strip()[:80] for x in passages.splitlines() if x.strip()), "N/A")


class HashEmbedding:
    """Signed feature hashing of lower-cased words: equal texts get equal vectors, shared words bring vectors near."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
                out[i, h % self.dim] += 1 if h >> 63 else -1
        return out.tolist()


class LetterEmbedding:
    """How often each letter from a to z comes in the lower-cased text: whole numbers, so distances are exact."""

    dim = 26

    def embed(self, texts: list[str]) -> list[list[float]]:
        return [np.bincount(np.frombuffer(t.lower().encode("utf-8", "replace"), np.uint8), minlength=256)[97:123].astype(np.float32).tolist() for t in texts]


class Retrying:
    """A provider with a bounded number of tries and a least pause between calls."""

    def __init__(self, inner, tries: int = 3, pause: float = 0.0):
        self.inner, self.tries, self.pause, self.dim = inner, tries, pause, getattr(inner, "dim", 0)

    def _call(self, f, batch):
        for left in range(self.tries - 1, -1, -1):
            try:
                if self.pause:
                    time.sleep(self.pause)
                return f(batch)
            except Exception:
                if not left:
                    raise

    def complete(self, prompts):
        return self._call(self.inner.complete, prompts)

    def embed(self, texts):
        return self._call(self.inner.embed, texts)

    def fetch(self, urls):
        return self._call(self.inner.fetch, urls)


def _answers(call, values: list) -> dict:
    """Each value's (answer, error). A call that fails is made again in two halves, down to the values that fail by themselves."""
    if not values:
        return {}
    try:
        return {v: (a, None) for v, a in zip(values, call(values), strict=True)}
    except Exception as e:
        if len(values) == 1:
            return {values[0]: (None, f"{type(e).__name__}: {e}")}
        half = len(values) // 2
        return _answers(call, values[:half]) | _answers(call, values[half:])


def _mapped(df: DataFrame, column: str, call, kinds: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    names = df.columns
    at = names.index(column)

    def run(batches):
        for batch in batches:
            values = batch.column(at).to_pylist()
            known = _answers(call, list(dict.fromkeys(v for v in values if v is not None)))
            answers, errors = ([known.get(v, (None, None))[i] for v in values] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(answers, kinds[0][1]), pa.array(errors, pa.string())], names=[*names, kinds[0][0], kinds[0][0] + "_error"])

    return df.mapInArrow(run, appended(df, f"{kinds[0][0]} {kinds[0][2]}, {kinds[0][0]}_error string"))


def chat(df: DataFrame, prompt: str, provider: ChatProvider, out: str = "answer") -> DataFrame:
    """The rows with the model's answer; a null prompt is not asked. What fails by itself is told in `<out>_error`."""
    return _mapped(df, prompt, provider.complete, [(out, pa.string(), "string")])


def embed(df: DataFrame, text: str, provider: EmbeddingProvider, out: str = "embedding") -> DataFrame:
    """The rows with the text's vector."""
    return _mapped(df, text, provider.embed, [(out, pa.list_(pa.float32()), "array<float>")])


def fetch(df: DataFrame, url: str, provider: FetchProvider) -> DataFrame:
    """The rows with `status`, `body` and lower-cased `suffix` of the url; what was not answered with 200 has no body."""
    from pyspark.sql import functions as F

    from docloom.functions.text import url_suffix

    kind = pa.struct([("status", pa.int32()), ("body", pa.binary())])
    call = lambda urls: [{"status": s, "body": b if s == 200 else None} for s, b in provider.fetch(urls)]
    got = _mapped(df, url, call, [("_got", kind, "struct<status:int,body:binary>")])
    return got.select(*df.columns, F.col("_got.status").alias("status"), F.col("_got.body").alias("body"), url_suffix(F.col(url)).alias("suffix"), F.col("_got_error").alias("error"))
