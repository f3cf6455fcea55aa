"""The scorer boundary: a protocol, its deterministic test double, and parsing of what a scorer answers.

The double derives labels from a digest of the text. It is no model of sentiment.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import first_words, strip, to_boolean

#: The labels of the result format.
POLARITY = ("positive", "negative", "neutral", "mixed")
TOXICITY = ("none", "mild", "moderate", "severe")
DIRECTED_AT = ("general", "person", "group", "self", "topic")
EMOTIONS = ("joy", "anger", "annoyance", "amusement", "sadness", "fear", "surprise", "disgust", "neutral")
RESULTS = "message_id string, polarity string, polarity_score double, emotions string, sarcasm boolean, toxicity string, directed_at string, confidence double, rationale string"
_RAW = "struct<results:array<struct<message_id:string,polarity:string,polarity_score:string,emotions:array<string>,sarcasm:string,toxicity:string,directed_at:string,confidence:string,rationale:string>>>"


def output_schema() -> dict:
    """The answer's form as a JSON schema, from the label sets above."""
    text, of = {"type": "string"}, lambda names: {"type": "string", "enum": list(names)}
    fields = {
        "message_id": text, "polarity": of(POLARITY), "polarity_score": {"type": "number", "minimum": -1, "maximum": 1}, "emotions": {"type": "array", "items": of(EMOTIONS), "minItems": 1, "maxItems": 3},
        "sarcasm": {"type": "boolean"}, "toxicity": of(TOXICITY), "directed_at": of(DIRECTED_AT), "confidence": {"type": "number", "minimum": 0, "maximum": 1}, "rationale": text | {"maxLength": 200},
    }
    return {"type": "object", "properties": {"results": {"type": "array", "items": {"type": "object", "properties": fields, "required": list(fields)}}}, "required": ["results"]}


def doubled(windows: DataFrame) -> DataFrame:
    """Result rows of the test double, as expressions."""
    h = F.md5(F.coalesce("content", F.lit("")))
    digit = lambda k: F.ascii(F.substring(h, k, 1))  # noqa: E731  48 to 57 or 97 to 102
    pick = lambda names, k: F.element_at(F.array(*[F.lit(x) for x in names]), (digit(k) % len(names) + 1).cast("int"))
    return windows.select(
        F.col("message_id").cast("string").alias("message_id"), pick(POLARITY, 1).alias("polarity"), ((digit(2) - 75) / F.lit(27.0)).alias("polarity_score"),
        F.concat_ws(",", F.array_distinct(F.array(pick(EMOTIONS, 3), pick(EMOTIONS, 4)))).alias("emotions"), (digit(5) % 4 == 0).alias("sarcasm"),
        pick(TOXICITY, 6).alias("toxicity"), pick(DIRECTED_AT, 7).alias("directed_at"), ((digit(8) - 48) / F.lit(54.0)).alias("confidence"), F.concat(F.lit("digest "), F.substring(h, 1, 6)).alias("rationale"),
    )


@dataclass(frozen=True)
class Answer:
    """What a scorer may return instead of bare text: the text, and the tokens that the service counted."""

    text: str
    input_tokens: int | None = None
    candidate_tokens: int | None = None
    response_tokens: int | None = None


class Scorer(Protocol):
    """Answers one prompt with JSON text; an adapter to a hosted model sends it the message texts."""

    def answer(self, key: str, prompt: str) -> str | Answer: ...


def linear(step: float = 1.5) -> Callable[[int], float]:
    """Seconds to wait after the first, second, ... failure: step, twice step and so on."""
    return lambda failures: step * failures


def doubling(first: float, longest: float = 60.0) -> Callable[[int], float]:
    """Seconds to wait after the first, second, ... failure: first, then twice as long each time, `longest` at most."""
    return lambda failures: min(first * 2 ** (failures - 1), longest)


#: One row an attempt inside a batch's row: what a request log holds.
ATTEMPTS = "array<struct<attempt:int,failed:boolean,error:string,input_tokens:long,candidate_tokens:long,response_tokens:long,seconds:double>>"


def left_out(text: str, ids) -> list[str]:
    """The ids that an answer has no result for; ValueError where it has no list of results."""
    try:
        got = {str(r["message_id"]) for r in json.loads(text)["results"]}
    except (TypeError, KeyError, ValueError) as e:
        raise ValueError(f"no list of results: {type(e).__name__}: {e}") from e
    return [i for i in ids if i not in got]


def ask(batches: DataFrame, scorer: Scorer, attempts: int = 3, pause: Callable[[int], float] | None = None) -> DataFrame:
    """key, answer, error and attempts of each batch. A partition shares one scorer; attempts are pause(failures) seconds apart.

    An attempt fails if the scorer raises, or if batches have `ids` and the answer leaves one out. After the last attempt a batch keeps its error, and the last answer that it had.
    Write the result before anything else reads it: a scorer may answer differently if asked again.
    """
    checked = "ids" in batches.columns
    rows = batches.select("key", "prompt", F.col("ids") if checked else F.lit(None).cast("array<string>").alias("ids"))

    def tried(key: str, prompt: str, ids) -> tuple[str | None, str | None, list[dict]]:
        last, log = None, []
        for n in range(1, attempts + 1):
            began, error, said = time.monotonic(), None, None
            try:
                said = scorer.answer(key, prompt)
                said = said if isinstance(said, Answer) else Answer(said)
                last = said.text
                if checked and (missing := left_out(said.text, ids)):
                    raise ValueError(f"{len(missing)} of {len(ids)} ids are left out: {missing[:5]}")
            except Exception as e:  # noqa: BLE001  any failure of a remote call counts as one attempt
                error = f"{type(e).__name__}: {e}"
            tokens = {k: getattr(said, k, None) for k in ("input_tokens", "candidate_tokens", "response_tokens")}
            log.append({"attempt": n, "failed": error is not None, "error": error, **tokens, "seconds": time.monotonic() - began})
            if error is None:
                break
            if n < attempts and pause is not None:
                time.sleep(pause(n))
        return last, error, log

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = pa.list_(pa.struct([("attempt", pa.int32()), ("failed", pa.bool_()), ("error", pa.string()), ("input_tokens", pa.int64()), ("candidate_tokens", pa.int64()), ("response_tokens", pa.int64()), ("seconds", pa.float64())]))
        for b in frames:
            done = [tried(r["key"], r["prompt"], r["ids"]) for r in b.to_pylist()]
            texts = lambda k: pa.array([d[k] for d in done], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts(0), texts(1), pa.array([d[2] for d in done], log)], names=["key", "answer", "error", "attempts"])

    return rows.mapInArrow(run, f"key string, answer string, error string, attempts {ATTEMPTS}")


def score_batches(batches: DataFrame, scorer: Scorer, attempts: int = 3, wait: float = 0.0, longest: float = 60.0) -> DataFrame:
    """key, answer and error of each batch, as `ask` has them, with `wait` seconds after the first failure and twice as many after each further one."""
    return ask(batches, scorer, attempts, doubling(wait, longest) if wait else None).select("key", "answer", "error")


def request_log(answers: DataFrame) -> DataFrame:
    """One row an attempt of `ask`: key, attempt, failed, error, tokens and seconds."""
    return answers.select("key", F.explode("attempts").alias("a")).select("key", "a.*")


def _valid(r: Column) -> Column:
    score, sure = (r[c].try_cast("double") for c in ("polarity_score", "confidence"))
    ok = r["message_id"].isNotNull() & r["polarity"].isin(*POLARITY) & r["toxicity"].isin(*TOXICITY) & r["directed_at"].isin(*DIRECTED_AT)
    ok = ok & score.between(-1, 1) & sure.between(0, 1) & to_boolean(r["sarcasm"]).isNotNull() & (F.length(r["rationale"]) <= 200)
    known = F.forall(r["emotions"], lambda e: F.lower(strip(e)).isin(*EMOTIONS))
    return F.coalesce(ok & F.size(r["emotions"]).between(1, 3) & known, F.lit(False))


def parse_lines(lines: DataFrame) -> DataFrame:
    """lines(seq, value) with status and results: a line's results are taken all or none.

    status: blank, bad_json, error, no_text, bad_payload, invalid or ok. A line is parsed once, to a variant; a key counts as there if it is there with the value null as well:
    an error without a response is an error whatever it says, and neither a null response nor a null text of a candidate falls back to anything else.
    """
    v, line = F.col("value"), F.col("_line")
    once = lambda df, name, value: df.select(*df.columns, F.explode(F.array(value)).alias(name))  # noqa: E731  a generator keeps later steps from repeating value
    get = lambda source, path, kind="variant": F.try_variant_get(source, path, kind)
    parsed = once(lines.select("seq", F.explode(F.array("value")).alias("value")), "_line", F.try_parse_json(v))
    answered, first = get(line, "$.response").isNotNull(), "$.candidates[0].content.parts[0].text"

    def text(prefix: str) -> Column:
        told, plain = f"${prefix}{first[1:]}", f"${prefix}.text"
        return F.when(get(line, told).isNotNull(), get(line, told, "string")).otherwise(get(line, plain, "string"))

    found = F.struct(
        (line.isNotNull() & strip(v).startswith("{")).alias("json"), (get(line, "$.error").isNotNull() & ~answered).alias("error"),
        F.nullif(F.when(answered, text(".response")).otherwise(text("")), F.lit("")).alias("text"),
    )
    parsed = once(parsed, "_found", found).select("seq", "value", "_found.*")
    parsed = once(parsed, "_got", F.from_json("text", _RAW)["results"])
    status = (
        F.when(strip(F.coalesce(v, F.lit(""))) == "", "blank").when(~F.coalesce(F.col("json"), F.lit(False)), "bad_json").when(F.col("error"), "error")
        .when(F.col("text").isNull(), "no_text").when(F.col("_got").isNull(), "bad_payload").when(~F.forall("_got", _valid), "invalid").otherwise("ok")
    )
    told = once(parsed, "status", status)
    return told.select("seq", "status", F.when(F.col("status") == "ok", F.col("_got")).alias("results"))


def result_rows(parsed: DataFrame) -> DataFrame:
    """One typed row a result of the lines that are ok, with seq and position for deduplication."""
    rows = parsed.where("status = 'ok'").select("seq", F.posexplode("results").alias("position", "r"))
    feelings = F.array_distinct(F.transform(F.col("r.emotions"), lambda e: F.lower(strip(e))))
    return rows.select(
        "seq", "position", F.col("r.message_id").alias("message_id"), F.col("r.polarity").alias("polarity"), F.col("r.polarity_score").try_cast("double").alias("polarity_score"), F.array_join(feelings, ",").alias("emotions"),
        to_boolean(F.col("r.sarcasm")).alias("sarcasm"), F.col("r.toxicity").alias("toxicity"), F.col("r.directed_at").alias("directed_at"), F.col("r.confidence").try_cast("double").alias("confidence"), first_words(F.col("r.rationale")).alias("rationale"),
    )


def complete(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows(seq, message_id, ...) that their batch has asked for, asked(batch_id, message_id), of batches with an answer for each of its ids."""
    ids = asked.select(F.col("batch_id").alias("seq"), F.col("message_id").cast("string").alias("message_id"))
    own = rows.join(ids, ["seq", "message_id"], "left_semi")
    size = ids.groupBy("seq").agg(F.count(F.lit(1)).alias("_asked"))
    full = own.select("seq", "message_id").distinct().groupBy("seq").agg(F.count(F.lit(1)).alias("_got")).join(size, "seq").where("_got = _asked").select("seq")
    return own.join(full, "seq", "left_semi")
