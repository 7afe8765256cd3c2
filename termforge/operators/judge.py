"""Judges answer what the cascade leaves open: is a surface a form of a value, is a term meant in a sentence.

A judge gets candidates with ``open`` (form, relevance or null) and adds ``answer``. Each distinct question is put once.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Judge:
    def judge(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError


class NoJudge(Judge):
    """No judge: open questions stay open."""

    def judge(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("answer", F.lit(None).cast("boolean"))


class DenyJudge(Judge):
    """Every open question is answered no, as a judge without providers does."""

    def judge(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("answer", F.when(F.col("open").isNotNull(), False))


class TableJudge(Judge):
    """Answers from a table (surface, value, is_form), surfaces in lower case; what it lacks is no."""

    def __init__(self, verdicts: DataFrame):
        self.verdicts = verdicts

    def judge(self, rows: DataFrame) -> DataFrame:
        table = self.verdicts.select(F.col("surface").alias("surf"), F.col("value").alias("val"), "is_form").dropDuplicates(["surf", "val"])
        return rows.join(table, ["surf", "val"], "left").withColumn("answer", F.when(F.col("open").isNotNull(), F.coalesce("is_form", F.lit(False)))).drop("is_form")


class CallJudge(Judge):
    """Asks ``ask(prompt) -> content`` once for each distinct question; run it where the service may be called from.

    Questions go through few tasks (``tasks``), since a service's rate limit is shared. Errors count as no. A topic with a form question
    in a language that the service has no form questions for is set aside.
    """

    def __init__(self, ask: Callable[[str], str], tasks: int = 1, form_languages: tuple[str, ...] = ("ru",)):
        self.ask, self.tasks, self.form_languages = ask, tasks, form_languages

    def judge(self, rows: DataFrame) -> DataFrame:
        unsupported = (F.col("open") == "form") & ~F.col("lang").isin(*self.form_languages)
        # their topics are set aside, the others go on
        rows = rows.withColumn("set_aside", F.coalesce(unsupported, F.lit(False))).withColumn("open", F.when(~F.col("set_aside"), F.col("open")))
        sentence = F.when(F.col("open") == "relevance", F.col("text"))
        keys = rows.withColumn("asked_in", sentence)
        asked = keys.where("open is not null").select("open", "surf", "val", "value", "entry_type", "asked_in").distinct()
        prompt = F.when(F.col("open") == "form", form_prompt("entry_type", "value", "surf")).otherwise(relevance_prompt("entry_type", "surf", "asked_in"))
        ask = self.ask

        def answer(batches):
            import pyarrow as pa

            for batch in batches:
                out = []
                for p in batch.column("prompt").to_pylist():
                    try:
                        out.append(verdict(ask(p)))
                    except Exception:  # a failed call is a no
                        out.append(False)
                kept = [c for c in batch.schema.names if c != "prompt"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out)], [*kept, "answer"])

        told = asked.select("open", "surf", "val", "asked_in", prompt.alias("prompt")).coalesce(self.tasks).mapInArrow(answer, "open string, surf string, val string, asked_in string, answer boolean")
        told = told.select(F.col("open").alias("o"), F.col("surf").alias("s"), F.col("val").alias("v"), F.col("asked_in").alias("t"), "answer")
        same = (F.col("open") == F.col("o")) & (F.col("surf") == F.col("s")) & (F.col("val") == F.col("v")) & F.col("asked_in").eqNullSafe(F.col("t"))
        return keys.join(told, same, "left").drop("o", "s", "v", "t", "asked_in")


def form_prompt(entry_type: str, value: str, surface: str):
    kind = F.coalesce(F.col(entry_type), F.lit("term"))
    return F.format_string("Kind: %s. Dictionary word: %s. Candidate: %s. Is the candidate a grammatical form of the word? Answer TRUE or FALSE.", kind, F.col(value), F.col(surface))


def relevance_prompt(entry_type: str, surface: str, sentence: str):
    kind = F.coalesce(F.col(entry_type), F.lit("term"))
    return F.format_string("Sentence: %s\nDoes the word %s mean a %s here? Answer TRUE or FALSE.", F.col(sentence), F.col(surface), kind)


def verdict(content: str | None) -> bool:
    return (content or "").strip().upper().startswith("TRUE")


# --- providers: state of a calling service, not data --------------------------------------------------------------------


class ProviderError(RuntimeError):
    # Kinds of failure, and those worth another attempt.
    KINDS = ("RATE_LIMIT", "TOKEN_LIMIT", "NETWORK_ERROR", "AUTH_ERROR", "INVALID_REQUEST", "SERVER_ERROR", "UNKNOWN")
    RETRYABLE = ("RATE_LIMIT", "TOKEN_LIMIT", "NETWORK_ERROR", "SERVER_ERROR")

    def __init__(self, kind: str, message: str = "", retry_after: float | None = None):
        super().__init__(message or kind)
        self.kind, self.retry_after = kind, retry_after

    @staticmethod
    def of_status(status: int, retry_after: float | None = None) -> ProviderError:
        kind = {429: "RATE_LIMIT", 401: "AUTH_ERROR", 400: "INVALID_REQUEST"}.get(status, "SERVER_ERROR" if 500 <= status < 600 else "UNKNOWN")
        return ProviderError(kind, f"status {status}", retry_after)


@dataclass
class Provider:
    name: str
    model: str = ""
    url: str = ""
    key: str = ""
    priority: int = 0
    per_minute: int = 0
    per_day: int = 0
    calls: list[float] = field(default_factory=list)  # when calls succeeded
    tokens: int = 0  # used so far, as the service tells
    rests_until: float = 0.0

    def free(self, now: float) -> bool:
        self.calls = [t for t in self.calls if now - t < 86_400]
        minute = sum(now - t < 60 for t in self.calls)
        return now >= self.rests_until and (not self.per_minute or minute < self.per_minute) and (not self.per_day or len(self.calls) < self.per_day)

    def body(self, prompt: str, temperature: float = 0.0, max_tokens: int = 16) -> dict:
        return {"model": self.model, "temperature": temperature, "max_tokens": max_tokens, "messages": [{"role": "user", "content": prompt}]}


def reply(provider: Provider, answer: str | dict) -> str:
    """The content of an answer: text, or the parsed body of a chat service, whose token usage is added to the provider's."""
    if isinstance(answer, str):
        return answer
    provider.tokens += int((answer.get("usage") or {}).get("total_tokens") or 0)
    choices = answer.get("choices") or []
    if not choices:
        raise ProviderError("UNKNOWN", "an answer without choices")
    return (choices[0].get("message") or {}).get("content") or ""


def read_providers(folder: str, env: dict[str, str] | None = None) -> list[Provider]:
    """Enabled providers with a key, by priority. ``<name>_key.json`` ({"key": ...}) comes before the file's own key, then
    the environment variable it names."""
    env = dict(os.environ) if env is None else env
    out = []
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".json") and not n.endswith("_key.json")):
        with open(os.path.join(folder, name), encoding="utf-8") as f:
            node = json.load(f)
        title = node.get("name") or name.removesuffix(".json")
        key_file = os.path.join(folder, f"{title}_key.json")
        key = node.get("apiKey") or ""
        if os.path.exists(key_file):
            with open(key_file, encoding="utf-8") as f:
                key = json.load(f).get("key") or key
        key = key or env.get(node.get("apiKeyEnv") or f"{title.upper()}_API_KEY", "")
        if node.get("enabled", True) and key:
            limits = node.get("rateLimits") or {}
            out.append(Provider(title, node.get("model", ""), node.get("baseUrl", ""), key, node.get("priority", 0), limits.get("requestsPerMinute", 0), limits.get("requestsPerDay", 0)))
    return sorted(out, key=lambda p: p.priority)


class Scheduler:
    """Round robin over providers by priority; those that rest or are at their limit are passed over.

    Limits count the calls that succeeded; a provider that says it is over its limit rests and starts counting afresh.
    """

    def __init__(self, providers: list[Provider], send: Callable[[Provider, dict], str | dict], clock: Callable[[], float] = time.time):
        self.providers, self.send, self.clock, self.next = sorted(providers, key=lambda p: p.priority), send, clock, 0

    def ask(self, prompt: str) -> str:
        error: ProviderError | None = None
        for _ in range(3 * len(self.providers)):
            provider = self.providers[self.next % len(self.providers)]
            self.next += 1
            now = self.clock()
            if not provider.free(now):
                continue
            try:
                content = reply(provider, self.send(provider, provider.body(prompt)))
                provider.calls.append(now)
                return content
            except ProviderError as e:
                error = e
                if e.kind == "RATE_LIMIT":
                    provider.rests_until, provider.calls = now + (e.retry_after or 60), []
                elif e.kind not in ProviderError.RETRYABLE:
                    provider.rests_until = now + 30
        raise error or ProviderError("RATE_LIMIT", "no provider is free")
