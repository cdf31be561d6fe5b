"""Live jobs: case states, first claims and measurements once, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.lineage import new_path
from millrace.registry import query

#: Typed state of custom operators is kept in this store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """A key's rows of one trigger, whose size the source bounds, by sequence (null first)."""
    return sorted(rows, key=lambda r: (r.sequence is not None, r.sequence or 0))


class CaseState(StatefulProcessor):
    """One value a case: its state and how often it has run. A step that is not allowed changes nothing."""

    def __init__(self, allowed: list[tuple[str, str]]):
        self.allowed = frozenset(allowed)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("case", "current string, attempt long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        current, attempt = self.state.get() if self.state.exists() else (None, 0)
        for r in _in_order(rows):
            fine = r.state is not None and (current is None or (current, r.state) in self.allowed)
            if fine:
                current, attempt = r.state, attempt + (r.state == "running")
            yield Row(case_id=key[0], sequence=r.sequence, state=r.state, accepted=fine, current=current, attempt=attempt)
        self.state.update((current, attempt))

    def close(self) -> None:
        pass


class FirstClaim(StatefulProcessor):
    """One value a fingerprint: the case that owns it, until it releases it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.owner = handle.getValueState("owner", "case_id long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        owner = self.owner.get()[0] if self.owner.exists() else None
        for r in _in_order(rows):
            if owner is None and not r.released:
                owner = r.case_id
            granted = owner is not None and owner == r.case_id
            yield Row(fingerprint=key[0], sequence=r.sequence, case_id=r.case_id, granted=granted)
            if granted and r.released:
                owner = None
        if owner is None:
            self.owner.clear()
        else:
            self.owner.update((owner,))

    def close(self) -> None:
        pass


def stream_measurement_dedupe(measurements: DataFrame, key: list[str]) -> DataFrame:
    """Each operation key once, however often it is measured and in whatever batch; null is a key like others."""
    return measurements.dropDuplicates(key)


def stream_case_state(events: DataFrame, allowed: list[tuple[str, str]]) -> DataFrame:
    """``events``: case_id, sequence, state. Accepts a case's first step, and then those of the table ``allowed``: accepted, current, attempt (times it has run).

    Steps of one trigger go by sequence (null first); one that comes in a later trigger is judged after those before it, whatever its sequence. A null state is refused.
    Needs ``STORE``. A restart from the checkpoint goes on with the states that it holds.
    """
    kind = "case_id long, sequence long, state string, accepted boolean, current string, attempt long"
    return events.groupBy("case_id").transformWithState(CaseState(allowed), kind, "Append", "None")


def stream_first_claim(claims: DataFrame) -> DataFrame:
    """``claims``: fingerprint, sequence, case_id, released. The first case owns a fingerprint until it releases it: granted.

    Order is that of ``stream_case_state``. A release by another case, or of what nobody owns, is not granted.
    """
    kind = "fingerprint string, sequence long, case_id long, granted boolean"
    return claims.groupBy("fingerprint").transformWithState(FirstClaim(), kind, "Append", "None")


@contextmanager
def typed_state(spark: SparkSession):
    """The store of typed state, for queries that start inside."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        yield
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


def run_once(spark: SparkSession, stream: DataFrame, path: str | None = None) -> DataFrame:
    """Drain what is available now into ``path`` (a new one in the shared folder), and read all that has been written there.

    With the ``path`` of an earlier run, the stream goes on where that one stopped.
    """
    path = path or new_path(spark, "stream")
    with typed_state(spark):
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/state")
        writer.trigger(availableNow=True).start(f"{path}/rows").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


#: Event types of the test table as states, and the allowed steps.
STATES = {"view": "planned", "click": "running", "add_to_cart": "measured", "purchase": "accepted", "error": "failed"}
ALLOWED = [("planned", "running"), ("running", "measured"), ("running", "failed"), ("measured", "accepted"), ("measured", "failed"), ("failed", "running")]


def _events(t) -> DataFrame:
    return t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events*.parquet")


query("stream_measurement_dedupe", "SELECT DISTINCT user_id, event_type FROM events")(lambda t: run_once(t.spark, stream_measurement_dedupe(_events(t).select("user_id", "event_type"), ["user_id", "event_type"])))
_STATE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATES.items()) + " END"
query("stream_case_state", f"""WITH RECURSIVE s AS (SELECT user_id AS case_id, event_id AS sequence, {_STATE} AS state, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events WHERE {_STATE} IS NOT NULL),
    k(a, b) AS (VALUES {', '.join(map(str, ALLOWED))}),
    r AS (
      SELECT case_id, sequence, state, n, true AS accepted, state AS current, CASE WHEN state = 'running' THEN 1 ELSE 0 END AS attempt FROM s WHERE n = 1
      UNION ALL
      SELECT s.case_id, s.sequence, s.state, s.n, k.a IS NOT NULL, CASE WHEN k.a IS NOT NULL THEN s.state ELSE current END, attempt + CASE WHEN k.a IS NOT NULL AND s.state = 'running' THEN 1 ELSE 0 END
      FROM r JOIN s ON s.case_id = r.case_id AND s.n = r.n + 1 LEFT JOIN k ON k.a = r.current AND k.b = s.state
    )
    SELECT case_id, sequence, state, accepted, current, CAST(attempt AS BIGINT) AS attempt FROM r""")(
    lambda t: run_once(t.spark, stream_case_state(_events(t).select(F.col("user_id").alias("case_id"), F.col("event_id").alias("sequence"), F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])[F.col("event_type")].alias("state")).where("state is not null"), ALLOWED))
)
query("stream_first_claim", "WITH c AS (SELECT 'k' || (event_id % 500) AS fingerprint, event_id AS sequence, user_id AS case_id FROM events) SELECT fingerprint, sequence, case_id, case_id = first_value(case_id) OVER (PARTITION BY fingerprint ORDER BY sequence) AS granted FROM c")(
    lambda t: run_once(t.spark, stream_first_claim(_events(t).select(F.concat(F.lit("k"), (F.col("event_id") % 500).cast("string")).alias("fingerprint"), F.col("event_id").alias("sequence"), F.col("user_id").alias("case_id"), F.lit(False).alias("released"))))
)
