"""Turn timelines, speaker drift and turn gaps."""

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from auralith.dims import BARGE_IN_DEPTH, BREATHINESS, DRIFT_TARGETS, GAPS, OVERLAP_CHANCES, OVERLAP_DEPTH, PAUSE_CHANCE, frame, uniform


def _turns() -> WindowSpec:
    return Window.partitionBy("scene").orderBy("idx")


def previous_turn(turns: DataFrame) -> DataFrame:
    """W7."""
    return turns.select("scene", "idx", F.lag("role").over(_turns()).alias("prev_role"), F.lag("intensity").over(_turns()).alias("prev_intensity"))


def script_timeline(turns: DataFrame) -> DataFrame:
    """Onsets and offsets by a running sum of lengths and, for sequential turns, gaps (negative ones are none). turns: scene, idx, seconds, amount, mode."""
    step = F.when(F.col("mode") == "sequential", F.greatest("amount", F.lit(0.0))).otherwise(F.lit(0.0)) + F.col("seconds")
    end = F.sum(step).over(_turns().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return turns.select("scene", "idx", F.round(end - F.col("seconds"), 6).alias("onset"), F.round(end, 6).alias("offset"))


def truncated_by_next(turns: DataFrame) -> DataFrame:
    """Turns that the next one barges into, whose audible length falls short of the script's by more than two samples, or that are marked so.

    turns: scene, idx, mode, seconds (script), audible (seconds), truncated."""
    cut = F.coalesce(F.lead("mode").over(_turns()) == "barge_in", F.lit(False)) | F.coalesce(F.col("audible") < F.col("seconds") - 2 / 16_000, F.lit(False)) | F.col("truncated")
    return turns.select("scene", "idx", cut.alias("truncated"))


def label_times(turns: DataFrame, pad: float = 0.5) -> DataFrame:
    """Onset, offset and truncated of the label of each turn, shifted by the silence before the clip; a truncated turn is a sample long at least, others 0.1 s.

    turns: scene, idx, onset, offset (audible), seconds (script)."""
    cut = F.col("offset") - F.col("onset") < F.col("seconds") - 2 / 16_000
    first = F.col("onset") + pad
    return turns.select("scene", "idx", F.round(first, 7).alias("onset"), F.round(F.greatest(F.col("offset") + pad, first + F.when(cut, 1 / 16_000).otherwise(0.1)), 7).alias("offset"), cut.alias("truncated"))


def safe_end(onset: Column, end: Column, duration: Column) -> Column:
    """A sample after the onset at least, and inside the scene where that leaves a length."""
    floor = F.greatest(end, onset + 1 / 16_000)
    return F.when(duration > onset, F.least(floor, duration)).otherwise(floor)


Fold = Callable[[Iterator[tuple]], Iterator[tuple]]


def folded(rows: DataFrame, by: list[str], order: str, columns: list[str], schema: str, fold: Fold) -> DataFrame:
    """What `fold` makes of each group's rows in order; the rows come sorted through a stream, so that a group may be of any length. fold: rows (columns) -> rows (schema, without the group's keys)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    keys = [f for f in rows.schema.fields if f.name in by]
    out = StructType(keys + StructType.fromDDL(schema).fields)
    arrow, names = to_arrow_schema(out), [k.name for k in keys]
    sorted_rows = rows.select(*names, *columns).repartition(*names).sortWithinPartitions(*names, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        made: list[tuple] = []
        for key, group in groupby(stream, key=lambda r: r[: len(names)]):
            for row in fold(r[len(names) :] for r in group):
                made.append((*key, *row))
                if len(made) == 4096:
                    yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow)], schema=arrow)
                    made = []
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow)], schema=arrow)

    return sorted_rows.mapInArrow(run, out)


_TARGETS = {(role, i): t for role, i, *t in DRIFT_TARGETS}


def drift_step(state: list[float], last: int | None, role: str, intensity: int) -> list:
    """The speaker's rate, pitch, volume and breathiness after a turn, and the turn's intensity within 1 to 5; last: that of the turn before."""
    i = max(1, min(5, intensity))
    aim = [*_TARGETS.get((role, i), (1.0, 0.0, 0.0)), BREATHINESS[i - 1] if role == "VIC" else 0.0]
    k = 0.6 if last is None or i >= last else 0.3
    return [*(s + k * (t - s) for s, t in zip(state, aim, strict=True)), i]


def speaker_drift(turns: DataFrame) -> DataFrame:
    """Rate, pitch, volume and breathiness of each speaker before each of its turns: 60 % of the way to the target of role and intensity, 30 % where the intensity falls."""

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        state, last = [1.0, 0.0, 0.0, 0.0], None
        for idx, role, intensity in rows:
            yield (idx, *state)
            *state, last = drift_step(state, last, role, intensity)

    names = ["rate", "pitch", "volume", "breathiness"]
    out = folded(turns, ["scene", "speaker"], "idx", ["idx", "role", "intensity"], "idx bigint, " + ", ".join(f"{n} double" for n in names), fold)
    return out.select("scene", "speaker", "idx", *[F.round(n, 6).alias(n) for n in names])


def rendered_timeline(turns: DataFrame, rate: int = 16_000) -> DataFrame:
    """Script, rendered and audible times of each turn of a scene, in whole samples.

    turns: scene, idx, mode, amount (gap or depth), samples, speech_end (W12). A sequential turn follows all that is placed after its gap; others reach back into the speech of the turn before,
    never beyond its onset. A turn that is barged into ends with its speech, or at once where the other begins before it.
    """

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        cursor = script = 0.0
        earlier, last = 0, None  # the latest end but the last turn's; the last turn: idx, script times, onset, end, speech_end
        for idx, mode, amount, samples, speech in rows:
            amount, length = max(0.0, amount), samples / rate
            if mode == "sequential":
                onset, begin = cursor + amount, script + amount
            else:
                begin = script
                onset = max(0.0, cursor - amount) if last is None else max(last[3] / rate, last[3] / rate + last[5] / rate - min(amount, last[5] / rate))
            script, first = begin + length, int(onset * rate)
            if last is not None:
                at, cut = first - last[3], min(last[5], last[4] - last[3])
                if mode == "barge_in" and (at <= 0 or cut > at):
                    last = (*last[:4], last[3] + (0 if at <= 0 else cut), last[5])
                yield last[0], last[1], last[2], last[3] / rate, last[4] / rate
                earlier = max(earlier, last[4])
            last = (idx, begin, begin + length, first, first + samples, speech)
            cursor = max(earlier, last[4]) / rate
        if last is not None:
            yield last[0], last[1], last[2], last[3] / rate, last[4] / rate

    out = folded(turns, ["scene"], "idx", ["idx", "mode", "amount", "samples", "speech_end"], "idx bigint, script_onset double, script_offset double, onset double, offset double", fold)
    return out.select("scene", "idx", *[F.round(c, 7).alias(c) for c in ("script_onset", "script_offset", "onset", "offset")])


def audible(turns: DataFrame, timeline: DataFrame) -> DataFrame:
    """The turns with the seconds that are heard of each; turns: scene, idx, ...; timeline: W5b's rows."""
    return turns.join(timeline.select("scene", "idx", (F.col("offset") - F.col("onset")).alias("audible")), ["scene", "idx"])


def monotonic(rows: DataFrame, by: list[str], order: str, value: str, slack: float = 0.01) -> DataFrame:
    """Whether no value falls below the one before it by more than the slack; by group."""
    before = F.lag(value).over(Window.partitionBy(*by).orderBy(order))
    return rows.withColumn("__ok", F.coalesce(before <= F.col(value) + slack, F.lit(True))).groupBy(*by).agg(F.bool_and("__ok").alias("monotonic"))


def turn_gaps(turns: DataFrame, seed: int = 42, table: list[tuple] = GAPS) -> DataFrame:
    """Mix mode and amount of each transition: first turns and others by context, overlaps and barge-ins by the transition's chances."""
    spark = turns.sparkSession
    chances = frame(spark, OVERLAP_CHANCES, "c_prev string, c_role string, c_intensity int, barge double, overlap double")
    gaps = frame(spark, table, "context string, low double, high double")
    draw = lambda k: uniform(F.lit(str(seed)), F.col("scene").cast("string"), F.col("idx").cast("string"), F.lit(k))
    rows = turns.withColumn("prev_role", F.lag("role").over(_turns())).withColumn("prev_i", F.lag("intensity").over(_turns()))
    rows = rows.join(chances, (F.col("prev_role") == F.col("c_prev")) & (F.col("role") == F.col("c_role")) & (F.col("intensity") == F.col("c_intensity")), "left")
    first = F.col("prev_role").isNull()
    mode = F.when(~first & (draw("roll") < F.col("barge")), "barge_in").when(~first & (draw("roll") < F.col("barge") + F.col("overlap")), "overlap").otherwise("sequential")
    context = F.when(first, "agg_low").when(F.col("role") == "VIC", F.when(F.col("prev_i") <= 2, "vic_low").when(F.col("prev_i") == 3, "vic_i3").when(F.col("prev_i") == 4, "vic_i4").otherwise("vic_i5"))
    context = context.when((F.col("role") == "AGG") & (F.col("intensity") >= 4), F.when(draw("pause") < PAUSE_CHANCE, "agg_pause").otherwise("agg_high")).when((F.col("role") == "AGG") & (F.col("intensity") == 3), "agg_high").otherwise("agg_low")
    rows = rows.withColumn("mode", mode).withColumn("context", context).join(gaps, "context")
    between = lambda lo, hi: lo + (hi - lo) * draw("amount")
    amount: Column = F.when(F.col("mode") == "barge_in", between(F.lit(BARGE_IN_DEPTH[0]), F.lit(BARGE_IN_DEPTH[1]))).when(F.col("mode") == "overlap", between(F.lit(OVERLAP_DEPTH[0]), F.lit(OVERLAP_DEPTH[1]))).otherwise(between(F.col("low"), F.col("high")))
    return rows.select("scene", "idx", "mode", F.round(amount, 6).alias("amount"))
