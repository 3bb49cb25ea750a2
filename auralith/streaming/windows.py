"""Analysis windows over event time, batch and streaming."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_counts(events: DataFrame, length_s: int = 10_800, hop_s: int = 3_600) -> DataFrame:
    """Events in windows of length_s every hop_s; events: ts (timestamp)."""
    w = F.window("ts", f"{length_s} seconds", f"{hop_s} seconds")
    return events.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.unix_timestamp("w.start").alias("window_start"), "n")


def streamed_counts(stream: DataFrame, late: str = "1 hour", length_s: int = 10_800, hop_s: int = 3_600) -> DataFrame:
    """R1 on a stream: the same windows behind a watermark."""
    return sliding_counts(stream.withWatermark("ts", late), length_s, hop_s)


def append_new(stream: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Rows whose keys haven't been seen within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def long_enough(events: DataFrame, least_s: float = 0.1) -> DataFrame:
    """R2: events of at least the shortest length that is labelled; events: onset, offset in seconds."""
    return events.where(F.col("offset") - F.col("onset") >= least_s)


def streamed_drift(turns: DataFrame) -> DataFrame:
    """W6 on a stream: each speaker's rate, pitch, volume and breathiness before each of its turns, its state kept between batches. Turns of a speaker must come in order.

    turns: scene, speaker, idx, role, intensity."""
    from auralith.operators.timeline import drift_step

    def step(key, frames, state):
        import pandas as pd

        held = list(state.get) if state.exists else [1.0, 0.0, 0.0, 0.0, None]
        out = []
        for frame in frames:
            for r in frame.sort_values("idx").itertuples():
                out.append((*key, r.idx, *held[:4]))
                held = drift_step(held[:4], held[4], r.role, r.intensity)
        state.update(tuple(held))
        yield pd.DataFrame(out, columns=["scene", "speaker", "idx", "rate", "pitch", "volume", "breathiness"])

    names = "rate double, pitch double, volume double, breathiness double"
    return turns.groupBy("scene", "speaker").applyInPandasWithState(step, f"scene long, speaker string, idx long, {names}", f"{names}, last int", "append", "NoTimeout")
