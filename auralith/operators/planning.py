"""Planning of runs: speaker rotation, acoustic variants, selection, batches of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auralith import dims
from auralith.dims import uniform
from auralith.operators.validate import DEVICES, ROOMS

# Chance, smallest and largest signal-to-noise ratio in dB.
SNR_BANDS = [(0.50, 18.0, 30.0), (0.30, 10.0, 18.0), (0.10, 5.0, 10.0), (0.10, 30.0, 40.0)]
DISTANCES = [0.5, 1.5, 3.5]


def pools(speakers: DataFrame, seed: int) -> DataFrame:
    """Context, role, split, candidate, slot, size: each pool's speakers in hash order; those of both contexts are in two pools. speakers: speaker, role, context, split."""
    contexts = F.when(F.col("context") == "both", F.array(*[F.lit(p) for p in dims.PROJECTS])).otherwise(F.array("context"))
    rows = speakers.select(F.explode(contexts).alias("context"), "role", "split", F.col("speaker").alias("candidate"))
    key = Window.partitionBy("context", "role", "split")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "candidate"))
    return rows.withColumn("slot", F.row_number().over(key.orderBy(order, "candidate")) - 1).withColumn("size", F.count("*").over(key))


def distribute_speakers(scenes: DataFrame, speakers: DataFrame, seed: int = 42) -> DataFrame:
    """Scene, speaker, replacement: the speakers of scenes that another one of the same context, role and split stands in for, in turn.

    scenes: scene, project, pos, speaker (a row a speaker of a scene); speakers: a row a speaker. Unknown speakers and those that stay have no row.
    """
    known = scenes.join(speakers.select("speaker", "role", "context", "split"), "speaker")
    known = known.withColumn("context", F.when(F.col("context") == "both", F.col("project")).otherwise(F.col("context")))
    key = Window.partitionBy("context", "role", "split").orderBy("scene", "pos")
    pool = pools(speakers, seed)
    sizes = pool.select("context", "role", "split", "size").distinct()
    turn = known.withColumn("n", F.row_number().over(key) - 1).join(sizes, ["context", "role", "split"]).withColumn("slot", (F.col("n") % F.col("size")).cast("int"))
    out = turn.join(pool.drop("size"), ["context", "role", "split", "slot"]).where("candidate <> speaker")
    return out.select("scene", "speaker", F.col("candidate").alias("replacement"))


def sampled_snr(*seed: Column) -> Column:
    """A ratio from the bands: one number picks the band, another the place in it."""
    pick, place = uniform(*seed, F.lit("band")), uniform(*seed, F.lit("place"))
    out, upto = F.lit(None).cast("double"), 0.0
    for chance, low, high in SNR_BANDS:
        out = F.when(pick.between(upto, upto + chance) & out.isNull(), low + (high - low) * place).otherwise(out)
        upto += chance
    return F.coalesce(out, F.lit(SNR_BANDS[-1][1]))


def variants(configs: DataFrame, n: int, seed: int = 42, devices: list[str] | None = None, rooms: list[str] | None = None) -> DataFrame:
    """Scene, variant, room_type, device, distance, snr: n variants of each configuration, from the given devices and rooms or all."""
    for given, valid, what in ((devices, DEVICES, "devices"), (rooms, ROOMS, "rooms")):
        if given is not None and (not given or set(given) - set(valid)):
            raise ValueError(f"{what} must be some of {sorted(valid)}")
    rows = configs.select("scene", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("variant"))
    own = (F.lit(str(seed)), F.col("scene").cast("string"), F.col("variant").cast("string"))
    pick = lambda values, k: F.get(F.array(*[F.lit(v) for v in values]), F.floor(uniform(*own, F.lit(k)) * len(values)).cast("int"))
    return rows.select("scene", "variant", pick(sorted(rooms or ROOMS), "room").alias("room_type"), pick(sorted(devices or DEVICES), "device").alias("device"), pick(DISTANCES, "distance").alias("distance"), F.round(sampled_snr(*own), 1).alias("snr"))


def selected(scenes: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """L3 by target: the first scenes of each typology in hash order, as many as it asks for. scenes: scene, typology; targets: typology, n."""
    order = Window.partitionBy("typology").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("scene").cast("string"))), "scene")
    ranked = scenes.withColumn("place", F.row_number().over(order))
    return ranked.join(F.broadcast(targets), "typology").where("place <= n").select("scene", "typology")  # a row a typology


def batch_plan(scenes: DataFrame, targets: DataFrame, pairs: DataFrame, most: int | None = None, seed: int = 42) -> DataFrame:
    """Scene, typology, split: the scenes of a run, capped, with speaker-disjoint splits. pairs: scene, speaker."""
    from auralith.operators import graph

    chosen = selected(scenes, targets, seed)
    if most is not None:
        chosen = chosen.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("scene").cast("string")))).limit(most)
    linked = chosen.join(pairs, "scene", "left").select(F.col("scene").alias("clip"), "speaker")
    return chosen.join(graph.splits(graph.components(linked), seed=seed).withColumnRenamed("clip", "scene"), "scene")


def judge_plan(models: DataFrame, clips: DataFrame, runs: int) -> DataFrame:
    """Every clip for each of a few models, several times."""
    return clips.crossJoin(F.broadcast(models)).withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))


def onset(duration: Column, absolute: Column, phase: Column, offset: Column) -> Column:
    """The absolute onset, else the phase's share of the duration (half for unknown ones), else 0; with its offset, inside the clip."""
    share = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in dims.PHASES for x in p]), phase), F.lit(0.5))
    base = F.coalesce(absolute, F.when(phase.isNotNull(), share * duration), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(base + F.coalesce(offset, F.lit(0.0)), duration - 0.1))


def retried(work, most: int = 3):
    """The result of `work`, tried up to `most` times; the last error is raised."""
    for k in range(most):
        try:
            return work()
        except Exception:
            if k == most - 1:
                raise


def cost(spark: SparkSession, clips: DataFrame, runs: int) -> DataFrame:
    """Model, usd: audio minutes and answers (half a thousand tokens each) at each model's prices. clips: seconds."""
    # Model, price of a minute of audio, price of a thousand tokens.
    prices = dims.frame(spark, [("gemini", 0.0125, 0.0050), ("openai", 0.10, 0.020)], "model string, minute double, tokens double")
    whole = clips.agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("s"), F.count("*").alias("n"))
    return prices.crossJoin(whole).select("model", F.round(F.col("s") / 60 * runs * F.col("minute") + 0.5 * F.col("n") * runs * F.col("tokens"), 4).alias("usd"))
