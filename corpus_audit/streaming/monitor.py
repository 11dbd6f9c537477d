"""The link monitor as a stream: state transitions, host alerts per run window, newly arrived documents.

``transitions`` is the batch form: probes of one url may be any number, and the two-level ``neighbors`` orders them without
a per-url task.  ``stream_changes`` is the same as keyed state: per url the last definitive probe and what the watermark
has not passed yet, woken by event-time timers.

A stream cannot see that a url is gone from the pages: dropping keys happens only in the batch ``next_baseline``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpus_audit.functions import text as tx
from corpus_audit.operators import links
from corpus_audit.operators.structure import heading_scope
from corpus_audit.scale import neighbors
from corpus_audit.sources.files import read_display_lines

STATE_DDL = "url string, status string, content_hash string, ts timestamp"


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE_DDL)


def transitions(probes: DataFrame, state: DataFrame, slice_by: str = "day") -> tuple[DataFrame, DataFrame]:
    """(changes, next state) for probes (url, ts, seq, status, content_hash, authoritative) on top of a state.

    Each probe is compared with the last definitive one before it; inconclusive probes neither change state nor
    report, except that the first sight of a url is ``new`` whatever its status.
    """
    known = state.select("url", F.lit(True).alias("_known"))
    first = probes.groupBy("url").agg(F.min(F.struct("ts", "seq")).alias("_f"))
    first = first.join(known, "url", "left_anti").select("url", "_f.ts", "_f.seq").withColumn("change", F.lit("new"))
    past = state.filter(F.col("status") != links.INCONCLUSIVE).select(
        "url", "ts", F.lit(-1).cast("bigint").alias("seq"), "status", "content_hash", F.lit(None).cast("boolean").alias("authoritative")
    )
    definitive = probes.filter(F.col("status") != links.INCONCLUSIVE).select(
        "url", "ts", "seq", "status", "content_hash", "authoritative"
    )
    chain = neighbors(
        definitive.unionByName(past), ["url"], ["ts", "seq"], ["status", "content_hash"], F.date_trunc(slice_by, "ts"), previous="_prev"
    ).filter(F.col("authoritative").isNotNull())
    change = links.change_of(
        F.col("status"), F.col("content_hash"), F.col("authoritative"), F.lit(True), F.col("_prev.status"), F.col("_prev.content_hash")
    )
    seen = first.select("url", "ts", "seq", F.lit(True).alias("_new"))
    later = chain.join(seen, ["url", "ts", "seq"], "left_anti").withColumn("change", change).filter(F.col("change").isNotNull())
    changes = later.select("url", "ts", "seq", "change").unionByName(first)
    rows = definitive.select("url", "status", "content_hash", "ts", "seq").unionByName(
        past.select("url", "status", "content_hash", "ts", "seq")
    )
    last = rows.groupBy("url").agg(F.max_by(F.struct("status", "content_hash", "ts"), F.struct("ts", "seq")).alias("s"))
    settled = last.select("url", "s.status", "s.content_hash", "s.ts")
    everyone = probes.groupBy("url").agg(F.max("ts").alias("ts")).unionByName(state.select("url", "ts"))
    open_urls = everyone.groupBy("url").agg(F.max("ts").alias("ts")).join(settled.select("url"), "url", "left_anti")
    undecided = open_urls.select("url", F.lit(links.INCONCLUSIVE).alias("status"), F.lit(None).cast("string").alias("content_hash"), "ts")
    return changes, settled.unionByName(undecided)


class _Transitions(StatefulProcessor):
    """State of one url: its last definitive probe, and the probes that the watermark has not passed yet.

    A probe is judged once the watermark passes its event time, so all probes before it have arrived or are too late to
    count; what is judged leaves ``pending``.  One timer per url and batch stands at the oldest pending probe.
    """

    def __init__(self, retention_us: int | None):
        self.retention_us = retention_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status string, content_hash string, at bigint, definitive boolean")
        self.pending = handle.getListState("pending", "at bigint, seq bigint, status string, content_hash string, authoritative boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((initialState.status, initialState.content_hash, initialState.at, initialState.status != links.INCONCLUSIVE))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [(r.at, r.seq, r.status, r.content_hash, r.authoritative) for r in rows]
        if arrived:
            self.pending.appendList(arrived)
            self._wake(min(p[0] for p in arrived))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        probes = {tuple(p) for p in self.pending.get()} if self.pending.exists() else set()  # a replayed probe counts once
        ripe = sorted((p for p in probes if p[0] <= passed), key=lambda p: (p[0], p[1]))
        later = [p for p in probes if p[0] > passed]
        if ripe:
            if later:
                self.pending.put(later)
                self._wake(min(p[0] for p in later))
            else:
                self.pending.clear()
        last = tuple(self.last.get()) if self.last.exists() else None
        out, before = [], last
        for at, seq, status, digest, authoritative in ripe:
            if last is not None and self.retention_us is not None and at - last[2] > self.retention_us:
                last = None  # forgotten, whether or not its timer has fired by now
            change = None
            decided = status != links.INCONCLUSIVE
            if last is None:
                change = "new"
            elif decided and last[3]:
                if status == links.DEAD and last[0] == links.OK:
                    change = "went_dead"
                elif status == links.OK and last[0] == links.DEAD:
                    change = "recovered"
                elif authoritative and status == links.OK and None not in (digest, last[1]) and digest != last[1]:
                    change = "content_changed"
            if change:
                out.append(Row(url=key[0], at=at, seq=seq, change=change))
            if decided:
                last = (status, digest, at, True)
            elif last is None or not last[3]:
                last = (status, None, at, False)
        if last is not None and self.retention_us is not None and not later:
            if last[2] + self.retention_us <= passed:
                self.last.clear()
                return iter(out)
            if last != before:
                self._wake(last[2] + self.retention_us)
        if last is not None and last != before:
            self.last.update(last)
        return iter(out)

    def _wake(self, at_us: int) -> None:
        self.handle.registerTimer(-(-at_us // 1000))

    def close(self) -> None:
        pass


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BEAT = "url string, ts timestamp, seq bigint, status string, content_hash string, authoritative boolean"


def heartbeat(spark: SparkSession, folder: str, ts: Column) -> None:
    """Let event time move on to ``ts`` where no probe does: a row without a url, which only the watermark sees."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _BEAT.split(", ")) if c != "ts"]
    spark.range(1).select(ts.cast("timestamp").alias("ts"), *none).select(*[x.split()[0] for x in _BEAT.split(", ")]).coalesce(1).write.mode(
        "append"
    ).parquet(folder)


def stream_changes(
    probes: DataFrame, lateness: str = "1 day", retention_days: int | None = None, initial: DataFrame | None = None
) -> DataFrame:
    """Streaming (url, ts, seq, change) for probes (url, ts, seq, status, content_hash, authoritative), keyed by url.

    Equal to ``transitions`` over all probes that arrive within ``lateness`` of the newest one, in whatever order and
    however often they arrive; later ones are dropped.  State is kept per url, so a batch reads and writes
    the urls it holds and those whose timers fire.  With ``retention_days`` a url without a definitive probe for so
    long is forgotten, and is new when it comes again.  ``initial`` (url, status, content_hash, ts) is a baseline to
    start from.  Rows without url or time take no part, a null time also leaves the watermark alone.
    """
    # one condition that needs the time: a filter on the url alone would be pushed below the watermark and hide heartbeats
    keyed = probes.withWatermark("ts", lateness).where(F.when(F.col("ts").isNotNull(), F.col("url")).isNotNull())
    keyed = keyed.withColumn("at", F.unix_micros("ts"))
    known = None
    if initial is not None:
        known = initial.select("url", "status", "content_hash", F.unix_micros("ts").alias("at")).groupBy("url")
    retention = None if retention_days is None else retention_days * 86_400_000_000
    changes = keyed.groupBy("url").transformWithState(
        _Transitions(retention), "url string, at bigint, seq bigint, change string", "append", "EventTime", known
    )
    return changes.select("url", F.timestamp_micros("at").alias("ts"), "seq", "change")


def start_transitions(
    probes: DataFrame,
    changes_dir: str,
    checkpoint: str,
    lateness: str = "1 day",
    retention_days: int | None = None,
    initial: DataFrame | None = None,
    beats: str | None = None,
) -> StreamingQuery:
    """Append the changes to ``changes_dir``; a replayed batch is committed once by the file sink.

    State lives in the checkpoint, in as many parts as ``spark.sql.shuffle.partitions`` says at the first start.  ``beats``
    is a folder for ``heartbeat``; it must be there on every start of a checkpoint or on none.
    """
    spark = probes.sparkSession
    if beats is not None:
        store, path = _path(spark, beats)
        store.mkdirs(path)
        columns = [x.split()[0] for x in _BEAT.split(", ")]
        probes = probes.select(*columns).unionByName(spark.readStream.schema(_BEAT).parquet(beats))
    changes = stream_changes(probes, lateness, retention_days, initial)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)  # the query takes a copy of the settings as it starts
    try:
        return (
            changes.writeStream.format("parquet")
            .outputMode("append")
            .option("path", changes_dir)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(name, before)


def current_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(url, status, content_hash, ts) as the last committed batch left it: a baseline for ``stream_changes`` or ``diff``."""
    last = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return last.select("key.url", "value.status", "value.content_hash", F.timestamp_micros("value.at").alias("ts"))


def _path(spark: SparkSession, place: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def rot_alerts(probes: DataFrame, run: str = "7 days", lateness: str = "1 day", min_urls: int = links.ROT_MIN_URLS, percent: int = links.ROT_PERCENT, host: Column | None = None) -> DataFrame:
    """Hosts whose urls mostly died, per event-time run window; the same plan for a batch and for a stream.

    First the last status per (window, url), then counts per (window, host): both are keyed aggregates with
    partial combination, so a busy host or url is combined before it is shuffled.
    """
    timed = probes.withWatermark("ts", lateness).withColumn("host", tx.host_of("url") if host is None else host)
    last = timed.groupBy(F.window("ts", run).alias("w"), "host", "url").agg(F.max_by("status", F.struct("ts", "seq")).alias("status"))
    counts = last.groupBy(F.window("w", run).alias("run"), "host").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == links.DEAD).alias("dead")
    )
    hit = counts.filter(links.rotten(F.col("total"), F.col("dead"), min_urls, percent))
    return hit.select(F.col("run.start").alias("run_start"), "host", "total", "dead")


def new_documents(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """Stream of newly arrived files: (path, text), one row per file."""
    return (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def start_link_intake(docs: DataFrame, keywords: list[str], refs_dir: str, checkpoint: str) -> StreamingQuery:
    """Display lines, scope and links of every newly arrived document, appended per batch and replay-safe."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        scoped = heading_scope(read_display_lines(batch, "path"), ["path"], keywords)
        links.extract(scoped, ["path"]).write.mode("overwrite").parquet(f"{refs_dir}/batch={batch_id}")

    return docs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


INTAKE_DDL = "path string, digest string, modified timestamp"


def intake_changed(
    spark: SparkSession, folder: str, state_dir: str, handle: Callable[[DataFrame, int], None], glob: str = "*.md"
) -> int:
    """Hand over every content that was not seen before, as (path, digest, text), and remember it; the number of the run.

    A file counts by the sha256 of its bytes: a copy under another name, or a file that was only touched, is not handed
    over again, a file that changed under its name is.  Several new files of one content are handed over once, under
    their smallest path.  Only files that changed since the newest one of the state (less a second) are read.

    The state is a folder per run, written after ``handle`` returns: if that fails, the next call has the same number and
    sees the same contents, so ``handle`` should overwrite what it wrote under its number.  Bytes that are no UTF-8 text give
    a null text.
    """
    store, path = _path(spark, state_dir)
    runs = [int(f.getPath().getName()[4:]) for f in store.listStatus(path) if f.getPath().getName().startswith("run=")] if store.exists(path) else []
    run = max(runs, default=-1) + 1
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    known = spark.createDataFrame([], INTAKE_DDL)
    if runs:
        known = spark.read.schema(INTAKE_DDL).parquet(*[f"{state_dir}/run={r}" for r in sorted(runs)])
        newest = known.agg(F.date_format(F.max("modified") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("t")).first().t
        files = files.option("modifiedAfter", newest).option("timeZone", spark.conf.get("spark.sql.session.timeZone")) if newest else files
    found = files.load(folder).select(
        "path", F.sha2("content", 256).alias("digest"), F.col("modificationTime").alias("modified"), F.try_validate_utf8(F.col("content").cast("string")).alias("text")
    )
    fresh = found.join(known.select("digest").distinct(), "digest", "left_anti")
    fresh = fresh.groupBy("digest").agg(F.min_by(F.struct("path", "modified", "text"), "path").alias("f")).select("f.path", "digest", "f.modified", "f.text")
    pending = f"{state_dir}/pending"
    fresh.write.mode("overwrite").parquet(pending)  # what this run hands over and remembers, read once
    taken = spark.read.schema(INTAKE_DDL + ", text string").parquet(pending)
    handle(taken.select("path", "digest", "text"), run)
    taken.drop("text").write.mode("overwrite").parquet(f"{state_dir}/run={run}")
    return run
