"""Travel times from speed readings: cleaning, fan-out to segments, recency-weighted means and their running averages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewright.functions import timeslot as ts
from lanewright.functions.values import FEET_PER_MILE, flag, formula_version, half_even, travel_seconds, varied
from lanewright.operators import store
from lanewright.scratch import join_checked, materialise

LEAST_SPEED = 1.0
SPEED_RANGE = (0.0, 150.0)
EARLIEST = "2017-01-01"
SMOOTHING = 10
DEFAULT_SPEED_LIMIT = 25.0
READING_KEYS = ["segment_id", "time"]
#: Fanned-out readings that are sorted at a time; pairs of segment and link in a part of a plan, at most and where cores would else be idle.
SORTED_READINGS, PART_PAIRS, LEAST_PAIRS = 250_000, 1_000_000, 10_000
#: Pairs that are gathered by segment at a time; links that hand on a segment's label.
GATHERED_PAIRS, LABEL_LINKS = 500_000, 4


def clean_readings(raw: DataFrame) -> DataFrame:
    """All-string feed to (link_id, link_points, speed, observed_at); rows without speed or points go."""
    kept = raw.filter(F.col("speed").isNotNull() & F.col("link_points").isNotNull())
    return kept.select("link_id", "link_points", F.col("speed").try_cast("double").alias("speed"), F.try_to_timestamp("data_as_of").alias("observed_at"))


def reading_suspect(now: Column, speed: str = "speed", observed_at: str = "data_as_of") -> Column:
    """Here unknown and unparsable values are suspect, unlike in the trip rules."""
    v, t = F.col(speed).try_cast("double"), F.try_to_timestamp(F.col(observed_at).cast("string"))
    good = v.between(*SPEED_RANGE) & t.between(F.lit(EARLIEST).cast("timestamp"), now + F.expr("INTERVAL 1 DAY"))
    return ~F.coalesce(good, F.lit(False))


def drop_slow(readings: DataFrame, least: float = LEAST_SPEED) -> DataFrame:
    return readings.filter(F.col("speed") >= least)


def fan_out(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """A reading of a link becomes one of each segment that the link maps to."""
    side = materialise(mapping.select("link_id", F.col("segment_id").cast("string").alias("segment_id")), "link-map")
    return join_checked(readings, side, "link_id").select("segment_id", "speed", "observed_at")


def fan_out_totals(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """(segment_id, readings, total): count and sum of ``speed`` of what ``fan_out`` would return, one row a link being fanned out.

    Sums are exact where the speeds are whole numbers. A null speed is counted and adds nothing.
    """
    of_link = readings.groupBy("link_id").agg(F.count("*").alias("readings"), F.sum("speed").alias("total"))
    side = mapping.select("link_id", F.col("segment_id").cast("string").alias("segment_id"))
    return side.join(of_link, "link_id").groupBy("segment_id").agg(F.sum("readings").alias("readings"), F.sum("total").alias("total"))


def slot_means(readings: DataFrame) -> DataFrame:
    """Per (segment, slot): mean speed with weights 1..n in time order, and the newest time. Ties go by speed.

    One shuffle: rank and sums share the partitioning by (segment, slot).
    """
    r = readings.select("segment_id", ts.slot(F.col("observed_at")).alias("time"), "speed", "observed_at")
    rank = F.row_number().over(Window.partitionBy("segment_id", "time").orderBy("observed_at", "speed"))
    g = r.withColumn("w", rank).groupBy("segment_id", "time")
    return g.agg((F.sum(F.col("speed") * F.col("w")) / F.sum("w")).alias("avg_speed"), F.max("observed_at").alias("last_observed_at"))


def _ranked_means(seg: np.ndarray, link: np.ndarray, of: np.ndarray, t: np.ndarray, k: np.ndarray, v: np.ndarray, links: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Slot means (segment, k, mean, newest t) of pairs (seg, link) and readings (of, t, k, v) of the links, by segment and slot.

    All are codes from 0, pairs sorted by segment. Readings are ranked once by slot and time; so the ranks of a segment's readings,
    sorted, are all of its slots in order.
    """
    in_time = np.lexsort((v, t, k))
    rank = np.empty(len(t), np.uint32 if len(t) < 2**32 else np.int64)
    rank[in_time] = np.arange(len(t))
    t, k, v = t[in_time], k[in_time], v[in_time]
    by_link = rank[np.argsort(of, kind="stable")]
    size = np.bincount(of, minlength=links)
    start = np.cumsum(size) - size
    upto = np.cumsum(size[link])
    a, slots = 0, len(ts.SLOTS)
    while a < len(seg):
        # as many whole segments as are sorted at a time, one at least
        b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SORTED_READINGS, side="right"))
        b = int(np.searchsorted(seg, seg[min(b, len(seg) - 1)], side="left")) if b < len(seg) else b
        b = b if b > a else int(np.searchsorted(seg, seg[a], side="right"))
        n, who = size[link[a:b]], seg[a:b] - seg[a]
        if total := int(n.sum()):
            at = np.repeat(start[link[a:b]] - (np.cumsum(n) - n), n) + np.arange(total)
            # one number says segment, slot and place in time, so sorting it is all
            kind = np.uint32 if (int(who[-1]) + 1) * len(t) < 2**32 else np.int64
            x = np.repeat((who * len(t)).astype(kind), n) + by_link[at].astype(kind, copy=False)
            x.sort()
            who = x // kind(len(t))
            place = x - who * kind(len(t))
            cell = who.astype(np.int64) * slots + k[place]
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            count = np.diff(first, append=total)
            w = np.arange(1, total + 1) - np.repeat(first, count)
            newest = place[first + count - 1]
            # bincount adds one by one in time order, as a plain sum does; reduceat would add pairwise and round otherwise
            sums = np.bincount(np.repeat(np.arange(len(first)), count), weights=v[place] * w)
            yield who[first].astype(np.int64) + seg[a], k[newest], sums / (count * (count + 1) / 2), t[newest]
        a = b


def _joined(parts: Iterator[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    kinds = (np.int64, np.int64, np.float64, np.int64)
    return [np.concatenate([np.empty(0, kind), *found]) for kind, found in zip(kinds, list(zip(*parts)) or [()] * 4)]


def _flat(lists: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The values of a column of lists, and how many each has; a null list has none."""
    rows = lists.combine_chunks()
    return rows.flatten(), pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)


def _codes(column: pa.ChunkedArray | pa.Array, values: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(column, value_set=values), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _block_means(pairs: pa.Table, readings: pa.Table) -> pa.Table:
    """The slot means of a block: (segment_id, link_id) pairs and a row of readings (t, k, v) per link and month."""
    links = pc.unique(readings.column("link_id"))
    rows, n = _flat(readings.column("r"))
    of = np.repeat(_codes(readings.column("link_id"), links), n)
    t, k, v = (rows.field(c).to_numpy(zero_copy_only=False) for c in "tkv")
    names = pairs.column("segment_id").combine_chunks().dictionary_encode()
    seg, link = names.indices.to_numpy(zero_copy_only=False).astype(np.int64), _codes(pairs.column("link_id"), links)
    order = np.argsort(seg, kind="stable")
    order = order[link[order] >= 0]
    who, k, mean, t = _joined(_ranked_means(seg[order], link[order], of, t, k.astype(np.int64), v, len(links)))
    return pa.table({"segment_id": names.dictionary.take(pa.array(who)), "k": pa.array(k, pa.int32()), "avg_speed": mean, "t": t})


def _as_lists(offsets: np.ndarray, values) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def link_plan(mapping: DataFrame, lengths: DataFrame | None = None, once: bool = False) -> DataFrame:
    """Segments dealt into parts that share links, a row a part, to be used for any number of feeds.

    A row has ``part``, ``segments``, their ``feet`` (of ``lengths``, one a segment; segments without a row there are left out), the
    ``links`` of them all, and for each segment how many links it has (``sizes``) and which (``codes``). ``once``: a link that the
    mapping has several times for a segment counts once.

    A link's readings go to every part that has it. So segments go together by label: the least link of a segment is a label
    that its links hand on, and segments that hang together get one label. Large labels are split by segment, those of less than a
    quarter of a part share parts. Labels only say where a segment is worked on; any labels give the same means.
    """
    spark, kind = mapping.sparkSession, dict(mapping.dtypes)["link_id"]
    m = mapping.select("link_id", F.col("segment_id").cast("string").alias("segment_id")).filter("segment_id IS NOT NULL AND link_id IS NOT NULL")

    def gather(rows: pa.Table) -> pa.Table:
        names, links = (rows.column(c).combine_chunks().dictionary_encode() for c in ("segment_id", "link_id"))
        pair = names.indices.to_numpy().astype(np.int64) * len(links.dictionary) + links.indices.to_numpy()
        seg, link = np.divmod(np.unique(pair) if once else np.sort(pair), len(links.dictionary))
        offsets = np.append(0, np.cumsum(np.bincount(seg)))
        return pa.table({"segment_id": names.dictionary, "links": _as_lists(offsets, links.dictionary.take(pa.array(link)))})

    groups = max(-(-m.count() // GATHERED_PAIRS), 1)
    s = m.groupBy(F.pmod(F.xxhash64("segment_id"), F.lit(groups))).applyInArrow(gather, f"segment_id string, links array<{kind}>")
    if lengths is None:
        s = s.withColumn("feet", F.lit(None).cast("double"))
    else:
        s = join_checked(s, lengths.select("segment_id", F.col("length_ft").cast("double").alias("feet")), "segment_id")
    s = materialise(s.withColumn("least", F.array_min("links")), "segment-links")
    near = s.select("least", F.explode(F.array_append(F.slice("links", 1, LABEL_LINKS), F.col("least"))).alias("link_id"))
    near = materialise(near.groupBy("link_id").agg(F.min("least").alias("label")), "link-labels")
    far = near.join(near.select(F.col("link_id").alias("label"), F.col("label").alias("next")), "label")
    far = materialise(far.select(F.col("link_id").alias("least"), F.col("next").alias("label")), "far-labels")
    s = join_checked(s, far, "least").drop("least")
    weights = s.groupBy("label").agg(F.sum(F.size("links")).alias("pairs"))
    weights = materialise(weights, "label-weights")
    total = weights.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    size = min(PART_PAIRS, max(LEAST_PAIRS, -(-total // (2 * spark.sparkContext.defaultParallelism))))
    split, few = F.ceil(F.col("pairs") / size), max(-(-total // size), 1)
    own = F.xxhash64("label", F.pmod(F.xxhash64("segment_id"), split))
    s = join_checked(s, weights, "label").withColumn("part", F.when(F.col("pairs") > size / 4, own).otherwise(F.pmod(F.xxhash64("label"), F.lit(few))))

    def pack(rows: pa.Table) -> pa.Table:
        flat, n = _flat(rows.column("links"))
        flat = flat.dictionary_encode()
        one = lambda x: _as_lists(np.array([0, len(x)]), x)
        columns = (rows.column("segment_id").combine_chunks(), rows.column("feet").combine_chunks(), flat.dictionary, pa.array(n, pa.int32()), flat.indices)
        return pa.table([rows.column("part")[:1].combine_chunks(), *map(one, columns)], names=["part", "segments", "feet", "links", "sizes", "codes"])

    packed = s.select("part", "segment_id", "feet", "links").groupBy("part")
    return materialise(packed.applyInArrow(pack, f"part long, segments array<string>, feet array<double>, links array<{kind}>, sizes array<int>, codes array<int>"), "link-plan")


def _at_parts(readings: DataFrame, plan: DataFrame) -> DataFrame:
    """(of, link, t, k, v): a link's readings of a month as lists, for each part that has the link."""
    k = ((F.hour("observed_at") * 60 + F.minute("observed_at")) / ts.SLOT_MINUTES).cast("tinyint")
    r = readings.filter("observed_at IS NOT NULL AND speed IS NOT NULL").withColumn("_m", F.date_trunc("month", "observed_at"))
    r = r.groupBy("link_id", "_m").agg(F.collect_list(F.struct(F.unix_micros(F.col("observed_at").cast("timestamp")).alias("t"), k.alias("k"), F.col("speed").cast("double").alias("v"))).alias("r"))
    r = r.select("link_id", *[F.col(f"r.{c}").alias(c) for c in "tkv"])
    met = plan.select(F.col("part").alias("of"), F.explode("links").alias("link_id"))
    return met.join(r, "link_id").select("of", F.col("link_id").alias("link"), "t", "k", "v")


def _means_by_part(readings: DataFrame, plan: DataFrame, out: Callable[..., pa.Table], ddl: str) -> DataFrame:
    """``out`` of (segments, their feet, and who, k, mean, t of their slots in order) for each part of a plan."""

    def means(part: pa.Table, met: pa.Table) -> pa.Table:
        if not part.num_rows:
            return out(pa.array([], pa.string()), pa.array([], pa.float64()), *_joined(iter(())))
        names, feet, links, n, link = (_flat(part.column(c))[0] for c in ("segments", "feet", "links", "sizes", "codes"))
        # links of all rows of the part are one after the other, as their codes are
        moved = np.repeat(np.cumsum(_flat(part.column("links"))[1]) - _flat(part.column("links"))[1], _flat(part.column("codes"))[1])
        link = link.to_numpy(zero_copy_only=False).astype(np.int64) + moved
        unique = pc.unique(links)
        link = _codes(links, unique)[link]
        seg = np.repeat(np.arange(len(names)), n.to_numpy(zero_copy_only=False))
        t, size = _flat(met.column("t"))
        t, k, v = (x.to_numpy(zero_copy_only=False) for x in (t, _flat(met.column("k"))[0], _flat(met.column("v"))[0]))
        of = np.repeat(_codes(met.column("link"), unique), size)
        return out(names, feet, *_joined(_ranked_means(seg, link, of, t, k.astype(np.int64), v, len(unique))))

    tasks = max(plan.count(), 1)
    at = _at_parts(readings, plan)
    return plan.repartition(tasks, "part").groupBy("part").cogroup(at.repartition(tasks, "of").groupBy("of")).applyInArrow(means, ddl)


def fanned_slot_means(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """``slot_means(fan_out(readings, mapping))`` without a row for each reading of each segment.

    Segments are dealt into parts (``link_plan``). A part gets, once, the readings of each of its links; they are fanned out and
    ranked inside it, some whole segments at a time. A link's readings of a month travel as one row. Readings need a time and a
    speed; others are left out.
    """

    def out(names: pa.Array, feet: pa.Array, who: np.ndarray, k: np.ndarray, mean: np.ndarray, t: np.ndarray) -> pa.Table:
        return pa.table({"segment_id": names.take(pa.array(who)), "k": pa.array(k, pa.int32()), "avg_speed": mean, "t": t})

    kind = dict(readings.dtypes)["observed_at"]
    found = _means_by_part(readings, link_plan(mapping), out, "segment_id string, k int, avg_speed double, t long")
    time = F.get(F.array(*[F.lit(x) for x in ts.SLOTS]), F.col("k"))
    return found.select("segment_id", time.alias("time"), "avg_speed", F.timestamp_micros("t").cast(kind).alias("last_observed_at"))


def fanned_values(readings: DataFrame, plan: DataFrame) -> DataFrame:
    """The batch of a feed, a row a segment: ``k`` (numbers of slots), ``value`` (whole seconds) and ``t`` (newest time, microseconds) as lists.

    As ``slot_seconds`` of the fanned-out readings, rounded half to even. ``bad`` counts a segment's times that aren't positive.
    """

    def out(names: pa.Array, feet: pa.Array, who: np.ndarray, k: np.ndarray, mean: np.ndarray, t: np.ndarray) -> pa.Table:
        keep = ~(mean <= 0)
        who, k, mean, t = who[keep], k[keep], mean[keep], t[keep]
        unknown = feet.is_null().to_numpy(zero_copy_only=False)[who]
        seconds = feet.to_numpy(zero_copy_only=False)[who] / FEET_PER_MILE / mean * 3600
        first = np.flatnonzero(np.diff(who, prepend=-1))
        offsets = np.append(first, len(who))
        bad = np.add.reduceat((seconds <= 0).astype(np.int64), first) if len(first) else first
        columns = (pa.array(k, pa.int8()), pa.array(np.rint(seconds) + 0.0, mask=unknown), t)
        return pa.table([names.take(pa.array(who[first])), *[_as_lists(offsets, c) for c in columns], pa.array(bad)], names=["segment_id", "k", "value", "t", "bad"])

    return _means_by_part(readings, plan, out, "segment_id string, k array<tinyint>, value array<double>, t array<long>, bad long")


def slot_seconds(readings: DataFrame, lengths: DataFrame) -> DataFrame:
    """(segment_id, time, last_observed_at, time_seconds) for segments of known length and positive mean speed."""
    return seconds_of(slot_means(readings), lengths)


def seconds_of(means: DataFrame, lengths: DataFrame) -> DataFrame:
    means = means.filter("avg_speed > 0")
    j = join_checked(means, lengths.select("segment_id", "length_ft"), "segment_id")
    return j.select("segment_id", "time", "last_observed_at", travel_seconds(F.col("length_ft"), F.col("avg_speed")).alias("time_seconds"))


def running_mean(new: DataFrame, state: DataFrame, today: str, keys: list[str] = READING_KEYS, window: int = SMOOTHING) -> DataFrame:
    """New slot values (keys, value, last_sample_at) merged with stored rows (keys, avg, count, last_sample_at).

    No stored row, or one without a count: start anew. The same sample time: a replay, nothing moves. Else the mean moves by
    the difference over min(count, window) and is rounded half to even; the count has no cap.
    """
    old = state.select(*keys, F.col("avg").alias("_avg"), F.col("count").alias("_n"), F.col("last_sample_at").alias("_at"), F.lit(True).alias("_known"))
    j = new.join(old, keys, "left")
    fresh = F.col("_known").isNull()
    replay = ~fresh & F.col("_at").eqNullSafe(F.col("last_sample_at"))
    reset = F.coalesce(F.col("_n"), F.lit(0)) == 0
    n = F.col("_n") + 1
    moved = F.coalesce("_avg", F.lit(0.0)) + (F.col("value") - F.coalesce("_avg", F.lit(0.0))) / F.least(n, F.lit(window))
    return j.select(
        *keys, "value", "last_sample_at",
        half_even(F.when(fresh, F.col("value")).when(replay, F.coalesce("_avg", "value")).when(reset, F.col("value")).otherwise(moved)).cast("double").alias("avg"),
        F.when(fresh, 1).when(replay, F.coalesce("_n", F.lit(1))).when(reset, 1).otherwise(n).cast("long").alias("count"),
        formula_version("v1", window).alias("avg_formula_version"), F.lit(today).cast("date").alias("updated_date"),
    )


def merge_lists(batch: DataFrame, state: DataFrame | None, lists: store.Lists | None, today: str, at: str = "timestamp", window: int = SMOOTHING) -> tuple[DataFrame, store.Lists]:
    """``store.upsert(state, running_mean(batch, state))`` with a row a segment on both sides and in the result.

    ``batch`` as from ``fanned_values``; ``state`` with its ``lists`` as from ``stored_lists``, None before the first. What the batch
    doesn't have stays as it is: other columns of the state, and rows of other segments or of no known slot. The tables meet by
    segment, so no row a slot is shuffled.
    """
    spark = batch.sparkSession
    version = spark.range(1).select(formula_version("v1", window)).first()[0]
    labels = {} if lists is None else lists.labels
    labels = {"time": ["string", list(ts.SLOTS)], "avg_formula_version": ["string", []], "updated_date": ["date", []]} | {c: [kind, list(values)] for c, (kind, values) in labels.items()}
    stamps = {}
    for c, now in (("avg_formula_version", version), ("updated_date", today)):
        stamps[c] = labels[c][1].index(now) if now in labels[c][1] else len(labels[c][1])
        labels[c][1] += [now] * (stamps[c] == len(labels[c][1]))
    made = {"value": "double", "last_sample_at": "timestamp", "avg": "double", "count": "bigint", **dict.fromkeys(stamps, "smallint")}
    cells = {} if state is None else {c: kind[len("array<") : -1] for c, kind in state.dtypes if c != "segment_id"}
    kinds = {"time": "smallint"} | {c: made.get(c, kind) for c, kind in cells.items() if c != "time"} | made
    j = batch.select("segment_id", "k", "value", "t")
    if state is not None:
        j = j.join(state.select("segment_id", *[F.col(c).cast(f"array<{kinds[c]}>").alias(f"_{c}") for c in cells]), "segment_id", "full_outer")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _merged_lists(pa.Table.from_batches([b]), list(cells), kinds, stamps, window)

    merged = j.mapInArrow(merge, "segment_id string, " + ", ".join(f"`{c}` array<{kind}>" for c, kind in kinds.items()))
    return merged.withColumn("last_sample_at", F.col("last_sample_at").cast(f"array<{at}>")), store.Lists("segment_id", labels)


def stored_lists(spark: SparkSession, table: str) -> tuple[DataFrame | None, store.Lists | None]:
    """A published table of slots, a row a segment, for ``merge_lists``; (None, None) before the first publication."""
    return store.current_lists(spark, table, "segment_id", {"time": list(ts.SLOTS), "avg_formula_version": [], "updated_date": []})


def _merged_lists(rows: pa.Table, kept: list[str], kinds: dict[str, str], stamps: dict[str, int], window: int) -> pa.RecordBatch:
    """A batch of joined rows merged: ``running_mean`` on numbers. ``kept`` are the state's columns, ``kinds`` those of the result."""
    slots = len(ts.SLOTS)
    numbers = lambda x, empty=0: pc.fill_null(x, empty).to_numpy(zero_copy_only=False)
    nulls = lambda x: x.is_null().to_numpy(zero_copy_only=False)
    k, n = _flat(rows.column("k"))
    value, t = _flat(rows.column("value"))[0], _flat(rows.column("t"))[0].to_numpy(zero_copy_only=False)
    k, row_new = k.to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(n)), n)
    place = np.full(rows.num_rows * slots, -1)
    place[row_new * slots + k] = np.arange(len(k))
    state = {c: _flat(rows.column(f"_{c}"))[0] for c in kept}
    n_old = _flat(rows.column("_time"))[1] if kept else np.zeros_like(n)
    row_old = np.repeat(np.arange(len(n_old)), n_old)
    slot = numbers(state["time"], -1).astype(np.int64) if kept else np.empty(0, np.int64)
    known = (slot >= 0) & (slot < slots)
    met = np.where(known, place[row_old * slots + np.where(known, slot, 0)], -1)
    fresh = np.ones(len(k), bool)
    fresh[met[met >= 0]] = False
    fresh = np.flatnonzero(fresh)
    # rows of the result: those of the state, with the place of the new one or -1, and new ones that the state doesn't have
    order = np.argsort(np.concatenate([row_old, row_new[fresh]]), kind="stable")
    o, m = np.concatenate([np.arange(len(met)), np.full(len(fresh), -1)])[order], np.concatenate([met, fresh])[order]
    ends = np.append(0, np.cumsum(n_old + np.bincount(row_new[fresh], minlength=rows.num_rows)))
    new = m >= 0
    o_new, m_new = o[new], m[new]
    old = o_new >= 0
    i = o_new[old]

    def before(c: str) -> tuple[np.ndarray, np.ndarray]:
        """The state's column beside the new values, and where it has none."""
        out, none = np.zeros(len(o_new), np.float64 if c == "avg" else np.int64), np.ones(len(o_new), bool)
        if c in state:
            column = state[c].cast(pa.int64()) if c != "avg" else state[c]
            out[old], none[old] = numbers(column)[i], nulls(column)[i]
        return out, none

    (was, no_avg), (count, no_count), (seen, no_seen) = before("avg"), before("count"), before("last_sample_at")
    v, no_value = numbers(value)[m_new], nulls(value)[m_new]
    replay = old & ~no_seen & (seen == t[m_new])
    anew = ~replay & (count == 0)
    least = np.minimum(count + 1, window)
    moved = was + (v - was) / np.where(least == 0, 1, least)
    avg = np.rint(np.where(anew, v, np.where(replay, np.where(no_avg, v, was), moved))) + 0.0
    no_avg = no_value & (~replay | no_avg)
    count = np.where(anew | replay & no_count, 1, np.where(replay, count, count + 1))
    made = {"value": pa.array(v, mask=no_value), "last_sample_at": pa.array(t[m_new]), "avg": pa.array(avg, mask=no_avg), "count": pa.array(count)}
    made |= {c: pa.array(np.full(len(m_new), code, np.int16)) for c, code in stamps.items()}
    at_new = np.cumsum(new) - 1
    out = {}
    for c, kind in kinds.items():
        if c == "time":
            out[c] = pa.array(np.where(o >= 0, slot[o] if kept else 0, k[m]), pa.int16())
            if kept and state[c].null_count:
                out[c] = pa.array(out[c].to_numpy(), mask=(o >= 0) & nulls(state[c])[o])
        elif c not in made:
            out[c] = state[c].take(pa.array(o, mask=o < 0))
        else:
            x = made[c].cast(pa.timestamp("us", "UTC")) if kind == "timestamp" else made[c]
            if new.all():
                out[c] = x
            elif c in state:
                out[c] = pa.concat_arrays([x, state[c].cast(x.type)]).take(pa.array(np.where(new, at_new, len(x) + o)))
            else:
                out[c] = x.take(pa.array(at_new, mask=~new))
    return pa.RecordBatch.from_arrays([rows.column("segment_id").combine_chunks(), *[_as_lists(ends, x) for x in out.values()]], names=["segment_id", *out])


def replay_means(history: DataFrame, keys: list[str], at: str = "last_sample_at", value: str = "value", window: int = SMOOTHING) -> DataFrame:
    """The running mean rebuilt from a history in time order: an order-dependent fold over each key's sorted values.

    A key's history is one row; for keys with unbounded history merge batch by batch with ``running_mean``.
    """
    h = history.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(F.col(at).alias("t"), F.col(value).cast("double").alias("v")))).alias("h"))
    start = F.struct(F.lit(0.0).alias("avg"), F.lit(0).cast("long").alias("n"), F.lit(None).cast(dict(history.dtypes)[at]).alias("t"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + 1
        replay = a["t"].eqNullSafe(x["t"])
        avg = F.when(a["n"] == 0, F.bround(x["v"])).otherwise(F.bround(a["avg"] + (x["v"] - a["avg"]) / F.least(n, F.lit(window))))
        return F.struct(F.when(replay, a["avg"]).otherwise(avg).alias("avg"), F.when(replay, a["n"]).otherwise(n).alias("n"), x["t"].alias("t"))

    out = h.select(*keys, F.aggregate("h", start, step).alias("a"))
    return out.select(*keys, F.col("a.avg").alias("avg"), F.col("a.n").alias("count"), F.col("a.t").alias(at))


def reference_speeds(network: DataFrame, default: float = DEFAULT_SPEED_LIMIT) -> DataFrame:
    """Posted speed, or the default where it is null or not positive."""
    return network.withColumn("reference_speed", F.when(F.col("speed_limit") > 0, F.col("speed_limit").cast("double")).otherwise(F.lit(default)))


def uncovered(network: DataFrame, covered: DataFrame) -> DataFrame:
    return network.join(covered.select("segment_id").distinct(), "segment_id", "left_anti")


def _own_buckets(readings: DataFrame, network: DataFrame, minutes: int) -> DataFrame:
    """A row per segment of ``network``: ``every`` bucket as an array (bucket, newest time), and ``own``, the positions of those it has.

    The buckets are as many as the time has half hours and go to every task as one row.
    """
    bucket = F.window("observed_at", f"{minutes} minutes").getField("start")
    r = readings.select(bucket.alias("bucket"), "segment_id", "observed_at")
    newest = r.groupBy("bucket").agg(F.max("observed_at").alias("at"))
    every = materialise(newest.agg(F.array_sort(F.collect_list(F.struct("bucket", "at"))).alias("every")), "buckets")
    place = every.select(F.posexplode("every").alias("place", "b")).select("place", "b.bucket")
    own = r.select("bucket", "segment_id").distinct().join(F.broadcast(place), "bucket").groupBy("segment_id").agg(F.collect_list("place").alias("own"))
    texts = every.select(F.transform("every", lambda b: F.struct(b["at"].alias("at"), b["bucket"].cast("string").alias("bucket"))).alias("every"), F.transform("every", lambda b, i: i).alias("places"))
    return reference_speeds(network).select("segment_id", "reference_speed").join(own, "segment_id", "left").crossJoin(F.broadcast(texts))


def gap_counts(readings: DataFrame, network: DataFrame, minutes: int = 30) -> DataFrame:
    """(segment_id, gaps, reference_speed) of segments without a reading in some bucket; the gaps themselves are not made."""
    gaps = F.size("places") - F.coalesce(F.size("own"), F.lit(0))
    return _own_buckets(readings, network, minutes).select("segment_id", gaps.cast("long").alias("gaps"), "reference_speed").filter("gaps > 0")


def fill_buckets(readings: DataFrame, network: DataFrame, minutes: int = 30) -> DataFrame:
    """For each time bucket, segments without a reading get one at a varied posted speed, stamped with the bucket's newest time.

    Segments are dealt once, each with the buckets it has; the grid of segments by buckets is made where it is used and not shuffled.
    """
    spark = readings.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    s = _own_buckets(readings, network.repartition(tasks, "segment_id"), minutes)
    places = F.when(F.col("own").isNull(), F.col("places")).otherwise(F.array_except("places", "own"))
    at = F.get("every", F.col("place"))
    made = s.withColumn("place", F.explode(places)).select("segment_id", varied(F.col("reference_speed"), F.col("segment_id"), at["bucket"]).alias("speed"), at["at"].alias("observed_at"))
    return readings.select("segment_id", "speed", "observed_at", F.lit(False).alias("synthetic")).unionByName(made.withColumn("synthetic", F.lit(True)))


def bucket_profile(readings: DataFrame, link: str = "segment_id", minutes: int = 30) -> DataFrame:
    """Newest time and number of distinct links per time bucket."""
    b = readings.groupBy(F.window("observed_at", f"{minutes} minutes").getField("start").alias("bucket"))
    return b.agg(F.max("observed_at").alias("latest"), F.count_distinct(link).alias("links"))


def free_flow(network: DataFrame) -> DataFrame:
    """Whole seconds at the posted speed, where length and speed are positive."""
    ok = network.filter((F.col("length_ft") > 0) & (F.col("speed_limit") > 0))
    return ok.select("segment_id", half_even(travel_seconds(F.col("length_ft"), F.col("speed_limit"))).cast("long").alias("avg"))


def backfill_slots(network: DataFrame, live: DataFrame) -> DataFrame:
    """A free-flow row for each segment and slot that has none; count and sample time stay null, so the next reading starts anew."""
    grid = free_flow(network).select("segment_id", "avg", F.explode(F.array(*[F.lit(s) for s in ts.SLOTS])).alias("time"))
    new = grid.join(live.select("segment_id", "time"), READING_KEYS, "left_anti")
    return new.select("segment_id", "time", F.col("avg").cast("double").alias("avg"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("timestamp").alias("last_sample_at"))


def snapshot_rows(state: DataFrame) -> DataFrame:
    """Per segment a map slot -> (value, avg, last_sample_at); slots with nothing to serve are left out.

    A value counts only with its sample time.
    """
    has = F.col("value").isNotNull() & F.col("last_sample_at").isNotNull()
    s = state.select("segment_id", "time", F.when(has, F.col("value")).alias("value"), "avg", F.when(has, F.col("last_sample_at")).alias("last_sample_at"))
    s = s.filter(F.col("value").isNotNull() | F.col("avg").isNotNull())
    entry = F.struct("time", F.struct("value", "avg", "last_sample_at").alias("v"))
    return s.groupBy("segment_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("slots"))


def not_positive(slots: DataFrame, column: str = "time_seconds") -> DataFrame:
    """Rows that must not be served: the caller stops if there is one."""
    return slots.filter(flag(F.col(column) <= 0))
