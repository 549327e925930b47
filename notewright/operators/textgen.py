"""The hook for text generation and model inference: a plain function, run in parallel on Arrow batches."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.constants import MIN_RESPONSE_CHARS
from notewright.errors import CallBudgetError, ContentFilteredError, RateLimitError, TextGenerationError

Generate = Callable[[str], str]


def stub(prompt: str) -> str:
    """A deterministic note made of the prompt's numbered diagnoses; the offline default."""
    names = [line.split(". ", 1)[1].split(" (Category")[0] for line in prompt.split("\n") if line[:1].isdigit() and ". " in line]
    said = " ".join(f"The patient was seen for {n.lower()} and examined with care." for n in names)
    return f"Subjective: {said or 'The patient feels well today.'} Objective: vital signs are stable. Plan: follow up in two weeks."


def provider_error(message: str) -> TextGenerationError:
    """A provider's message as an error: rate limit, content filter or other."""
    low = message.lower()
    if any(w in low for w in ("rate", "quota", "429")):
        return RateLimitError(message)
    if any(w in low for w in ("blocked", "safety", "content_filter", "policy")):
        return ContentFilteredError(message)
    return TextGenerationError(message)


@dataclass
class Client:
    """Calls ``generate`` once for a prompt, counts calls, and stops at ``budget`` calls (None: no bound) of one task."""

    generate: Generate
    budget: int | None = None
    calls: int = 0
    failed: int = 0
    limited: int = 0

    def call(self, prompt: str) -> str:
        """One call.  A rate limit is no failure; any other error is one."""
        if self.budget is not None and self.calls >= self.budget:
            raise CallBudgetError("the task's calls are spent", budget=self.budget)
        self.calls += 1
        try:
            return self.generate(prompt)
        except RateLimitError:
            self.limited += 1
            raise
        except Exception:
            self.failed += 1
            raise

    def __call__(self, prompt: str) -> str:
        return self.call(prompt)


@dataclass
class RetryingClient(Client):
    """Up to ``attempts`` x ``tries`` calls a prompt: a rate limit waits retry_after or 2**try, other errors one second;
    an answer of fewer than 50 characters is an error of the attempt.  ``spacing`` seconds pass between prompts."""

    attempts: int = 3
    tries: int = 3
    sleep: Callable[[float], None] = time.sleep
    spacing: float = 0.0

    def _answer(self, prompt: str) -> str:
        for n in range(self.tries):
            try:
                return self.call(prompt)
            except CallBudgetError:
                raise
            except Exception as e:
                if n == self.tries - 1:
                    raise
                self.sleep(e.retry_after or 2**n if isinstance(e, RateLimitError) else 1.0)
        raise TextGenerationError("no call was allowed")

    def __call__(self, prompt: str) -> str:
        error: Exception = TextGenerationError("no attempt was allowed")
        if self.spacing:
            self.sleep(self.spacing)
        for _ in range(self.attempts):
            try:
                text = self._answer(prompt)
            except CallBudgetError:
                raise
            except Exception as e:
                error = e
                continue
            if text and len(text.strip()) >= MIN_RESPONSE_CHARS:
                return text
            error = TextGenerationError("the answer is too short")
        raise error


def with_retries(generate: Generate, attempts: int = 3, calls: int = 3, sleep: Callable[[float], None] = time.sleep, spacing: float = 0.0) -> RetryingClient:
    """``generate`` with retries; see ``RetryingClient``."""
    return RetryingClient(generate, attempts=attempts, tries=calls, sleep=sleep, spacing=spacing)


def generate_text(rows: DataFrame, prompt: str, into: str, generate: Generate = stub, budget: int | None = None) -> DataFrame:
    """Adds the text generated from column ``prompt`` as ``into``, ``<into>_error``, and the calls made for the row:
    ``<into>_calls``, of which ``<into>_failed`` and ``<into>_limited``; a failed row has no text.

    A task makes at most ``budget`` calls; rows beyond fail without one.  Calls may be repeated when a task is;
    ``coalesce`` the rows first to bound how many run at a time.
    """

    def run(batches):
        client = replace(generate) if isinstance(generate, Client) else Client(generate)
        client.budget = budget if budget is not None else client.budget
        for b in batches:
            texts, errors, counts = [], [], []
            for p in b.column(prompt).to_pylist():
                before = (client.calls, client.failed, client.limited)
                try:
                    texts.append(client(p or ""))
                    errors.append(None)
                except Exception as e:
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
                counts.append([x - y for x, y in zip((client.calls, client.failed, client.limited), before)])
            columns = [pa.array([c[i] for c in counts], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string()), pa.array(errors, pa.string()), *columns], [*b.schema.names, into, *(f"{into}_{x}" for x in _ADDED)])

    added = [T.StructField(into, T.StringType()), T.StructField(f"{into}_error", T.StringType()), *(T.StructField(f"{into}_{x}", T.IntegerType()) for x in _ADDED[1:])]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))


_ADDED = ("error", "calls", "failed", "limited")


def _counters(into: str) -> list[Column]:
    ok = F.col(f"{into}_calls") - F.col(f"{into}_failed") - F.col(f"{into}_limited")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    rate = F.coalesce(F.try_divide(total(ok) * 100.0, total(ok) + total(F.col(f"{into}_failed"))), F.lit(100.0))
    return [F.count("*").alias("prompts"), F.count(into).alias("answered"), total(ok).alias("total_calls"), total(F.col(f"{into}_failed")).alias("failed_calls"), total(F.col(f"{into}_limited")).alias("limited_calls"), rate.alias("success_rate")]


def client_rates(made: DataFrame, into: str) -> DataFrame:
    """One row over generated rows: prompts, answered, total_calls (that succeeded), failed_calls, limited_calls, and
    success_rate, the per cent of calls that succeeded among these and the failed (100 without any)."""
    return made.agg(*_counters(into))


def observed(made: DataFrame, into: str, name: str = "client") -> tuple[DataFrame, Observation]:
    """``made``, and an observation that has the row of ``client_rates`` once an action has run over it."""
    watch = Observation(name)
    return made.observe(watch, *_counters(into)), watch
