"""The model as a pluggable function, the only effect of the engine: over HTTP, or a stand-in."""

from __future__ import annotations

import hashlib
import http.client
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lifecycle import NETWORK_CLASS, classify_outcome, retry_after

#: What a model function returns for each row it gets, in the same order; what it leaves out is null.
REPLY = "status int, content string, finish_reason string, failed boolean, retry_header string, prompt_tokens long, completion_tokens long, response string, started double, rtt double"
_NAMES = [c.strip().split(" ")[0] for c in REPLY.split(",")]
ModelFunction = Callable[[pd.DataFrame], pd.DataFrame]


class Pacer:
    """Admits one call every 60 / per_minute seconds; the first at once."""

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.step, self.clock, self.sleep = 60.0 / per_minute, clock, sleep
        self.next: float | None = None

    def admit(self, n: int = 1) -> float:
        """Waits for the next place, takes n of them, and tells the moment."""
        now = self.clock()
        at = now if self.next is None else max(now, self.next)
        self.next = at + n * self.step
        if at > now:
            self.sleep(at - now)
        return at


def _whole(said: pd.DataFrame) -> pd.DataFrame:
    kinds = {"int": "Int32", "long": "Int64", "boolean": "boolean", "double": "Float64", "string": object}
    return said.reindex(columns=_NAMES).reset_index(drop=True).astype({n: kinds[c.strip().split(" ")[1]] for n, c in zip(_NAMES, REPLY.split(","), strict=True)})


def model_calls(requests: DataFrame, model: ModelFunction, *, per_minute: float | None = None, partitions: int = 1) -> DataFrame:
    """Requests with their replies and outcome classes, by one call a row and no retry.

    A rate is kept by `partitions` tasks, each with its share of it, since executors have no
    common clock; calls without a rate stay in the partitions they come in. Checkpoint the result
    before use, and keep speculative execution off: a task that runs twice calls twice.
    """
    rate = per_minute / partitions if per_minute else None

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pacer = Pacer(rate) if rate else None
        for frame in frames:
            if not pacer:
                yield pd.concat([frame.reset_index(drop=True), _whole(model(frame))], axis=1)
                continue
            for i in range(len(frame)):
                pacer.admit()
                one = frame.iloc[i : i + 1].reset_index(drop=True)
                yield pd.concat([one, _whole(model(one))], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    dealt = requests.repartition(partitions) if rate else requests
    replied = dealt.mapInPandas(call, f"{own}, {REPLY}")
    return replied.withColumn("outcome", classify_outcome(F.col("status"), F.col("content"), F.col("finish_reason"), F.coalesce("failed", F.lit(False)))).withColumn("retry_after", retry_after(F.col("status"), F.col("retry_header")))


def replies(requests: DataFrame, model: ModelFunction, *, network: int = 5, kind: str = "initial", per_minute: float | None = None, partitions: int = 1, pause: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """All calls for requests that only network budgets bound: their columns, attempt_no,
    quota_kind, the reply, and `last` on the call that ended each one.

    Network-class errors are tried again, `network` calls in all; anything else ends a request.
    Each round is checkpointed at once, and `pause` gets it before the next one.
    """
    open_, calls = requests, None
    for number in range(1, network + 1):
        tried = open_.withColumn("attempt_no", F.lit(number)).withColumn("quota_kind", F.lit(kind))
        ended = ~F.col("outcome").isin(*NETWORK_CLASS) | F.lit(number == network)
        made = model_calls(tried, model, per_minute=per_minute, partitions=partitions).withColumn("last", ended).checkpoint()
        calls = made if calls is None else calls.unionByName(made)
        open_ = made.filter("not last").select(requests.columns)
        if number == network or open_.isEmpty():
            break
        if pause:
            pause(made, number)
    return calls


def backing_off(base: float = 5.0, cap: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """A pause between rounds: base, doubled each time up to a cap, or what the server asked for."""

    def pause(calls: DataFrame, number: int) -> None:
        row = calls.agg(F.count_if(F.col("outcome").isin(*NETWORK_CLASS)), F.max("retry_after")).first()
        if row[0]:
            sleep(max(min(base * 2.0 ** (number - 1), cap), row[1] or 0.0))

    return pause


@dataclass(frozen=True)
class Endpoint:
    """A chat completion service and the parameters of its calls."""

    url: str
    key: str
    model: str
    max_tokens: int = 32768
    temperature: float = 0.6
    top_p: float = 0.95
    top_k: int = 20
    presence_penalty: float = 0.0
    enable_thinking: bool = True
    request_timeout: float = 120.0
    connect_timeout: float = 30.0
    concurrent: int = 4

    def body(self, messages: str) -> bytes:
        settings = {n: getattr(self, n) for n in ("model", "max_tokens", "temperature", "top_p", "top_k", "presence_penalty")}
        return json.dumps(settings | {"messages": json.loads(messages), "chat_template_kwargs": {"enable_thinking": self.enable_thinking}}).encode()


def _post(to: Endpoint, messages: str) -> dict:
    """One call: what came back, or that it failed. The time limits of connecting and of the
    whole call are its own."""
    parts = urlsplit(to.url)
    kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
    link = kind(parts.hostname, parts.port, timeout=to.connect_timeout)
    out: dict = {"failed": False, "started": time.time()}
    begun = time.monotonic()
    try:
        link.connect()
        link.sock.settimeout(to.request_timeout)
        link.request("POST", f"{parts.path.rstrip('/')}/chat/completions", to.body(messages), {"Authorization": f"Bearer {to.key}", "Content-Type": "application/json"})
        answer = link.getresponse()
        data = bytearray()
        while part := answer.read1(1 << 16):
            data += part
            left = to.request_timeout - (time.monotonic() - begun)
            if left <= 0:
                raise TimeoutError
            link.sock and link.sock.settimeout(left)
        out |= {"status": answer.status, "retry_header": answer.headers.get("Retry-After")}
        if answer.status == 200:
            said = json.loads(data)
            choice = (said.get("choices") or [{}])[0]
            usage = said["usage"] if isinstance(said.get("usage"), dict) else {}
            out |= {"content": (choice.get("message") or {}).get("content"), "finish_reason": choice.get("finish_reason"), "response": json.dumps(said, ensure_ascii=False)}
            out |= {n: usage.get(n) or 0 for n in ("prompt_tokens", "completion_tokens") if usage}
    except (OSError, http.client.HTTPException, ValueError):
        out["failed"] = True
    finally:
        link.close()
    return out | {"rtt": time.monotonic() - begun}


def http_model(to: Endpoint, column: str = "messages") -> ModelFunction:
    """A model function that posts each row's messages, JSON text, `concurrent` at a time."""

    def model(frame: pd.DataFrame) -> pd.DataFrame:
        with ThreadPoolExecutor(max(1, min(to.concurrent, len(frame)))) as pool:
            return pd.DataFrame(list(pool.map(lambda m: _post(to, m), frame[column])), columns=_NAMES)

    return model


@dataclass(frozen=True)
class Faults:
    """Shares of calls that go wrong in each way; the rest is answered."""

    network: float = 0.0
    rate_limited: float = 0.0
    gateway: float = 0.0
    api: float = 0.0
    empty: float = 0.0
    truncated: float = 0.0


def stand_in(answer: Callable[[str, float], str], faults: Faults = Faults(), key: str = "sample_id", attempt: str = "attempt_no", seed: int = 42) -> ModelFunction:
    """A model whose reply is a digest of key and attempt, so that order and retries don't matter.

    `answer` gets the key and a number in 0..1 and gives the reply's text.
    """

    def share(*parts: object) -> float:
        return int(hashlib.md5(":".join(map(str, (seed, *parts))).encode()).hexdigest()[:12], 16) / float(1 << 48)

    def model(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for k, n in zip(frame[key], frame[attempt], strict=True):
            u, edge = share(k, n), 0.0
            text = answer(k, share(k, n, "answer"))
            row = (200, text, "stop", False, None, 100, 50, json.dumps({"choices": [{"message": {"content": text}, "finish_reason": "stop"}]}, ensure_ascii=False))
            for p, bad in (
                (faults.network, (None, None, None, True, None, None, None, None)),
                (faults.rate_limited, (429, None, None, False, "1.5", None, None, None)),
                (faults.gateway, (502, None, None, False, None, None, None, None)),
                (faults.api, (400, None, None, False, None, None, None, None)),
                (faults.empty, (200, "", "stop", False, None, 100, 0, "{}")),
                (faults.truncated, (200, "", "length", False, None, 100, 4096, "{}")),
            ):
                if edge <= u < edge + p:
                    row = bad
                edge += p
            rows.append(row)
        return pd.DataFrame(rows, columns=_NAMES[:8])

    return model
