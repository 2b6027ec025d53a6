"""Counters of a batch, by path and in total, and the progress of a stream."""

from __future__ import annotations

import bisect
import contextlib
import http.server
import itertools
import json
import logging
import threading
import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from siltlake.sinks.files import STAGES

log = logging.getLogger(__name__)
LEVELS = ("trace", "debug", "info", "warn", "error")


def counters() -> list[Column]:
    """Of a parsed batch: received, bytes in, processed, parse errors."""
    size = F.coalesce(F.octet_length("value"), F.lit(0))
    return [
        F.count(F.lit(1)).alias("received"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes_in"),
        F.coalesce(F.sum(F.col("_valid").cast("long")), F.lit(0)).alias("processed"), F.coalesce(F.sum((~F.col("_valid")).cast("long")), F.lit(0)).alias("parse_errors"),
    ]


def observed(df: DataFrame, name: str = "messages") -> tuple[DataFrame, Observation]:
    o = Observation(name)
    return df.observe(o, *counters()), o


def rollup(df: DataFrame, by: str = "_path") -> DataFrame:
    return df.groupBy(by).agg(*counters())


def histogram(df: DataFrame, value: Column, bounds: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative counts: how many values are at most each bound, and at most infinity (bound null)."""
    at_most = F.explode(F.array(*(F.struct(F.lit(float(b)).alias("bound"), (value <= b).cast("long").alias("hit")) for b in sorted(bounds)), F.struct(F.lit(None).cast("double").alias("bound"), F.lit(1).cast("long").alias("hit"))))
    return df.where(value.isNotNull()).select(*(by or []), at_most.alias("h")).groupBy(*(by or []), "h.bound").agg(F.sum("h.hit").alias("observations"))


def exposition(values: dict[str, float], prefix: str = "siltlake") -> str:
    """Counters in the Prometheus text format."""
    return "".join(f"# TYPE {prefix}_{n} counter\n{prefix}_{n} {v}\n" for n, v in sorted(values.items()))


class Registry:
    """Running totals of the process: counters, and per label where there is one; and histograms of seconds."""

    BOUNDS = (0.1, 0.5, 1, 5, 10, 30, 60, 300)

    def __init__(self):
        self._lock, self.totals, self.times = threading.Lock(), {}, {}

    def add(self, name: str, value: float = 1, **labels: str) -> None:
        key = (name, tuple(sorted(labels.items())))
        with self._lock:
            self.totals[key] = self.totals.get(key, 0) + value

    @contextlib.contextmanager
    def timed(self, stage: str):
        began = time.monotonic()
        try:
            yield
        finally:
            self.took(stage, time.monotonic() - began)

    def took(self, stage: str, seconds: float) -> None:
        with self._lock:
            counts, total = self.times.get(stage, ([0] * (len(self.BOUNDS) + 1), 0.0))
            counts[bisect.bisect_left(self.BOUNDS, seconds)] += 1
            self.times[stage] = (counts, total + seconds)

    def flushed(self, written: list[dict], reason: str) -> None:
        """A flush that went well; each file counts."""
        summary = flush_summary(written)
        self.add("flushes", reason=reason, result="ok")
        for name in ("files", "rows", "bytes_out"):
            self.add(name, summary[name])
        for w in written:
            for stage, wall, cpu in zip(STAGES, w.get("wall", ()), w.get("cpu", ())):
                self.took(f"file_{stage}", wall)
                self.add("file_cpu_seconds", cpu, stage=stage)

    def text(self, prefix: str = "siltlake") -> str:
        """All of it in the Prometheus text format."""
        with self._lock:
            totals, times = sorted(self.totals.items()), sorted(self.times.items())
        shown = lambda labels: "{" + ",".join(f"{k}={json.dumps(v)}" for k, v in labels) + "}" if labels else ""
        lines, seen = [], set()
        for (name, labels), value in totals:
            lines += [f"# TYPE {prefix}_{name} counter"] * (name not in seen) + [f"{prefix}_{name}{shown(labels)} {value}"]
            seen.add(name)
        if times:
            lines.append(f"# TYPE {prefix}_stage_seconds histogram")
        for stage, (counts, total) in times:
            for bound, n in zip((*map(str, self.BOUNDS), "+Inf"), itertools.accumulate(counts)):
                lines.append(f"{prefix}_stage_seconds_bucket{shown((('stage', stage), ('le', bound)))} {n}")
            lines += [f"{prefix}_stage_seconds_sum{shown((('stage', stage),))} {total}", f"{prefix}_stage_seconds_count{shown((('stage', stage),))} {sum(counts)}"]
        return "".join(x + "\n" for x in lines)

    def serve(self, port: int) -> http.server.ThreadingHTTPServer:
        """Answer GET /metrics in the background; close with shutdown()."""
        registry = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                found = self.path.split("?")[0] in ("/", "/metrics")
                body = registry.text().encode() if found else b""
                self.send_response(200 if found else 404)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_) -> None:
                pass

        server = http.server.ThreadingHTTPServer(("", port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server


METRICS = Registry()


def flush_summary(written: list[dict]) -> dict[str, int]:
    return {"files": len(written), "rows": sum(w["rows"] for w in written), "bytes_out": sum(w["bytes"] for w in written)}


class JsonLines(logging.Formatter):
    """A JSON object per line: time, level, message and extra fields."""

    def format(self, record: logging.LogRecord) -> str:
        level = {"WARNING": "warn", "CRITICAL": "error"}.get(record.levelname, record.levelname.lower())
        return json.dumps({"time": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(record.created)), "level": level, "msg": record.getMessage()} | getattr(record, "fields", {}))


def log_level(name: str | None) -> int:
    """trace < debug < info < warn < error; unknown names mean info."""
    return {"trace": 5, "debug": 10, "info": 20, "warn": 30, "error": 40}.get((name or "").lower(), 20)


class Progress(StreamingQueryListener):
    """Logs a line per micro-batch: rows, rates and the time that each part took."""

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info("batch %s: %s rows, %.1f in a second, %.1f processed, %s", p.batchId, p.numInputRows, p.inputRowsPerSecond or 0, p.processedRowsPerSecond or 0, dict(p.durationMs))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("terminated %s", event.id)
