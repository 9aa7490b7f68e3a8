"""Generation by a language model behind one interface.

Requests go through `mapInArrow` in bounded batches; a response stays in its request's row. The default generator is deterministic, offline and extractive:
a function of the request that SQL can express. `HttpGenerator` calls any chat-completions endpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from ..runtime import ship_package


@dataclass(frozen=True)
class Settings:
    """How a phase asks: by which model, how freely, how long."""

    model: str = "stub"
    temperature: float = 0.4
    max_tokens: int = 4096
    json_mode: bool = False


#: The phases and their published settings.
PHASES = {
    "questions": Settings("lite", 0.8, 1024, True), "answer": Settings("main", 0.4, 4096), "judge": Settings("lite", 0.1, 2048), "beyond_questions": Settings("lite", 0.8, 1024, True), "beyond_answer": Settings("main", 0.5, 4096),
    "flawed": Settings("lite", 0.8, 4096), "correction": Settings("main", 0.4, 4096), "treatment": Settings("main", 0.4, 4096), "strict_answer": Settings("main", 0.2, 4096), "hallucinated": Settings("lite", 0.9, 4096), "beyond_chosen": Settings("main", 0.2, 4096), "vision": Settings("vision", 0.2, 1024),
}


class Generator(Protocol):
    def generate(self, prompts: list[str], settings: Settings, systems: list[str | None] | None = None) -> list[tuple[str | None, str | None, str]]:
        """(text, reasoning, status) for each prompt and, if there are any, its system message; status is ok, error or timeout."""


@dataclass
class HttpGenerator:
    """A chat-completions endpoint, with a bounded number of calls at once in each task and retries."""

    url: str
    models: dict[str, str] = field(default_factory=dict)
    key: str = ""
    concurrency: int = 8
    retries: int = 3
    timeout: float = 180.0

    def _call(self, prompt: str, settings: Settings, system: str | None = None) -> tuple[str | None, str | None, str]:
        import time
        import urllib.error
        import urllib.request

        body = {"model": self.models.get(settings.model, settings.model), "messages": [*([{"role": "system", "content": system}] if system else []), {"role": "user", "content": prompt}], "temperature": settings.temperature, "max_tokens": settings.max_tokens}
        if settings.json_mode:
            body["response_format"] = {"type": "json_object"}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        status = "error"
        for attempt in range(self.retries + 1):
            try:
                with urllib.request.urlopen(urllib.request.Request(self.url, json.dumps(body).encode(), headers), timeout=self.timeout) as reply:
                    message = json.load(reply)["choices"][0]["message"]
                return message.get("content"), message.get("reasoning"), "ok"
            except TimeoutError:
                return None, None, "timeout"
            except (urllib.error.URLError, KeyError, IndexError, ValueError) as error:
                if isinstance(error, urllib.error.HTTPError) and error.code not in (429, *range(500, 600)):
                    break
                status = "timeout" if isinstance(getattr(error, "reason", None), TimeoutError) else "error"
                time.sleep(min(8.0, 0.5 * 2**attempt))
        return None, None, status

    def generate(self, prompts: list[str], settings: Settings, systems: list[str | None] | None = None) -> list[tuple[str | None, str | None, str]]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(self.concurrency) as pool:
            return list(pool.map(lambda p, s: self._call(p, settings, s), prompts, systems or [None] * len(prompts)))


def call(df: DataFrame, prompt: Column, generator: Generator, phase: str, name: str = "reply", system: Column | None = None) -> DataFrame:
    """df plus `name` (reasoning and content as one text, null after a failure) and `name`_status."""
    ship_package(df.sparkSession)
    settings = PHASES[phase]
    asked = df.withColumns({"__prompt": prompt, "__system": system if system is not None else F.lit(None).cast("string")})
    schema = StructType([*df.schema.fields, StructField("__content", StringType()), StructField("__reasoning", StringType()), StructField(f"{name}_status", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                prompts, systems = (rows.column(c).to_pylist() for c in ("__prompt", "__system"))
                replies = generator.generate(prompts, settings, systems) if any(systems) else generator.generate(prompts, settings)
                columns = [rows.column(c) for c in schema.names[:-3]] + [pa.array([r[k] for r in replies], pa.string()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = asked.mapInArrow(run, schema)
    reply = F.when(F.col(f"{name}_status") == "ok", T.with_reasoning(F.col("__content"), F.col("__reasoning")))
    return out.withColumn(name, reply).drop("__content", "__reasoning")


# The deterministic stub, as expressions: nothing leaves the JVM, and an oracle can compute the same.


def stub_questions(chunk: Column, n: int, round_: int = 0) -> Column:
    """n questions about the first words of a chunk, as a model's JSON reply."""
    subject = T.strip(F.regexp_replace(F.left(T._text(chunk), F.lit(40)), r"[^A-Za-z0-9 ]", ""))
    ask = [F.concat(F.lit(f"Question {round_ + 1}.{k + 1}: what does the source say about "), subject, F.lit("?")) for k in range(n)]
    return F.to_json(F.struct(F.array(*ask).alias("questions")))


def stub_answer(chunk: Column, question: Column) -> Column:
    """Thinking that repeats the question, then the start of the chunk."""
    return T.with_reasoning(F.concat(F.lit("The source says: "), F.left(T._text(chunk), F.lit(200))), F.concat(F.lit("Asked: "), T._text(question)))


def stub_flawed(chunk: Column, question: Column) -> Column:
    return F.concat(F.lit("[synthetic flaw] "), F.reverse(F.left(T._text(chunk), F.lit(120))))


def stub_correction(chunk: Column, question: Column, pushback: Column) -> Column:
    return T.with_reasoning(F.concat(F.lit("Corrected from the source: "), F.left(T._text(chunk), F.lit(200))), T._text(pushback))


def stub_limits(chunk: Column, question: Column) -> Column:
    """Says that the chunk leaves the question open, and what the chunk starts with."""
    return T.with_reasoning(F.concat(F.lit("The source does not settle this. It only says: "), F.left(T._text(chunk), F.lit(200))), F.concat(F.lit("Asked: "), T._text(question)))


def stub_verdict(answer: Column, chunk: Column) -> Column:
    """Grounded if the answer ends with text of the chunk; extrapolated if it shares its first word; else hallucinated."""
    tail = F.right(T.strip_thinking(answer), F.lit(40))
    return F.when(F.contains(T._text(chunk), tail), "VERDICT: GROUNDED").when(F.contains(answer, F.split_part(T._text(chunk), F.lit(" "), F.lit(1))), "VERDICT: EXTRAPOLATED").otherwise("VERDICT: HALLUCINATED")


def fill(template: str, **values: Column) -> Column:
    """A template with each {name} replaced by a column; doubled braces stand for themselves."""
    out = F.lit(template.replace("{{", "\u0003").replace("}}", "\u0004"))
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), T._text(value.cast("string")))
    return F.translate(out, "\u0003\u0004", "{}")


def request_key(model: str, prompt: Column) -> Column:
    """The key of a response table: a prompt that was answered is never asked again."""
    return F.sha2(F.concat(F.lit(model + "\u0000"), prompt), 256)


def unanswered(requests: DataFrame, responses: DataFrame, key: str = "request_key") -> DataFrame:
    return requests.join(responses.where("status = 'ok'").select(key).distinct(), key, "left_anti")
