"""Connectors to models of text, speech, recognition and scores: a registry of factories, called on executors, each model loaded once a worker.

No vendor's client is part of the library: factories for them are registered by the user. The stand-ins (name "stub") need no network and are deterministic.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Provider:
    """load: called once a worker, gives a function of one value; kind: llm, tts, asr, mos; styles: whether speech markup may name styles."""

    load: Callable[[], Callable]
    kind: str
    styles: bool = False


def _tone(ssml: str) -> bytes:
    from auralith.sinks.files import wav_bytes

    h = hashlib.sha256(ssml.encode()).digest()
    t = np.arange(24_000 // 10 * (5 + h[0] % 20)) / 24_000
    return wav_bytes((0.3 * np.sin(2 * np.pi * (100 + h[1]) * t)).tolist(), 24_000)


def _script(prompt: str) -> str:
    h = hashlib.sha256(prompt.encode()).digest()
    turns = [{"speaker_id": ("AGG_M_30-45_001", "VIC_F_25-40_002")[k % 2], "text": "שלום לך.", "intensity": 1 + h[k] % 5, "pause_before_s": 0.3, "emotional_state": "neutral"} for k in range(2 + h[0] % 5)]
    return "```json\n" + json.dumps({"turns": turns}, ensure_ascii=False) + "\n```"


#: (kind, name) -> provider. S19, S20, S21, S24, S25.
REGISTRY: dict[tuple[str, str], Provider] = {
    ("llm", "stub"): Provider(lambda: _script, "llm"),
    ("tts", "stub"): Provider(lambda: _tone, "tts", styles=True),
    ("asr", "stub"): Provider(lambda: lambda samples: "שלום לך" if samples is not None and len(samples) else "", "asr"),
    ("mos", "stub"): Provider(lambda: lambda samples: float(np.sqrt(np.mean(np.square(samples)))) if samples is not None and len(samples) else 0.0, "mos"),
}


def register(kind: str, name: str, provider: Provider) -> None:
    REGISTRY[kind, name] = provider


def provider(kind: str, name: str) -> Provider:
    """An unknown name is an error."""
    if (kind, name) not in REGISTRY:
        raise KeyError(f"no {kind} provider {name!r} is registered")
    return REGISTRY[kind, name]


def called(df: DataFrame, column: str, result: str, kind: str, name: str, sql_type: str, retries: int = 3) -> DataFrame:
    """Appends `result`, what the provider makes of the column's values, and error (null where it went well; the last one after `retries` tries)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

    chosen = provider(kind, name)
    made_type = _parse_datatype_string(sql_type)
    kept = [f for f in df.schema.fields if f.name not in (result, "error")]
    names, arrow = [f.name for f in kept], to_arrow_type(made_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            for i in range(batch.num_rows):
                row, value, error = batch.slice(i, 1), None, None
                for _ in range(retries):
                    try:
                        model = model or chosen.load()  # on the first row only
                        value, error = model(row.column(row.schema.get_field_index(column)).to_pylist()[0]), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([row.column(row.schema.get_field_index(n)) for n in names] + [pa.array([value], arrow), pa.array([error], pa.string())], names=[*names, result, "error"])

    return df.mapInArrow(run, StructType([*kept, StructField(result, made_type), StructField("error", StringType())]))
