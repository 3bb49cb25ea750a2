"""Fixed values of the label model, as plain tables; small dimension frames come from them."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Typology -> (largest intensity, tier 1, tier 2).
EVENT_BANDS = [
    ("NEU", 5, "NONE", "NONE_AMBIENT"),
    ("NEG", 5, "NONE", "NONE_ARGU"),
    ("IT", 2, "EMOT", "EMOT_GASLIT"),
    ("IT", 3, "EMOT", "EMOT_ISOL"),
    ("IT", 5, "VERB", "VERB_THREAT"),
    ("SV", 2, "VERB", "VERB_SHOUT"),
    ("SV", 3, "VERB", "VERB_THREAT"),
    ("SV", 4, "DIST", "DIST_SCREAM"),
    ("SV", 5, "PHYS", "PHYS_HARD"),
]
# Tier 1 categories and their tier 2 subtypes.
TAXONOMY = [
    ("PHYS", "PHYS_SOFT PHYS_HARD PHYS_WEAP PHYS_MOVE"),
    ("VERB", "VERB_HUMIL VERB_THREAT VERB_SHOUT VERB_COER"),
    ("DIST", "DIST_SCREAM DIST_PLEAD DIST_CRY DIST_BREATH DIST_CHILD"),
    ("ACOU", "ACOU_BREAK ACOU_SLAM ACOU_THROW ACOU_FOOT ACOU_FALL"),
    ("EMOT", "EMOT_GASLIT EMOT_ISOL EMOT_ECON EMOT_LEGAL"),
    ("NONE", "NONE_ARGU NONE_SPORT NONE_CHILD NONE_CRY_SAFE NONE_LAUGH NONE_CLINIC NONE_AMBIENT"),
]
TIER1 = [t for t, _ in TAXONOMY]
PARENTS = [(code, t) for t, codes in TAXONOMY for code in codes.split()]
# Typologies, roles, tiers, label sources, quality flags, mix modes, projects.
TYPOLOGIES, ROLES, TIERS, LABEL_SOURCES = ["SV", "IT", "NEG", "NEU"], ["AGG", "VIC", "BYS", "UNK"], ["A", "B", "C"], ["auto", "human", "auto_reviewed"]
QUALITY_FLAGS = ["low_snr", "clipping", "short_silence_pad", "label_uncertainty", "iaa_disagreement", "synthetic_artifact", "emotion_downgrade", "vic_f0_high", "agg_no_escalation", "warn_no_overlap", "warn_emotion_downgrade"]
PROJECTS = ["she_proves", "elephant_in_the_room"]
# Scene phase -> share of the duration where it begins.
PHASES = [("baseline", 0.05), ("tension", 0.25), ("escalation", 0.45), ("peak", 0.65), ("aftermath", 0.80), ("de-escalation", 0.90)]
# Emotions of the taxonomy.
EMOTIONS = ["anger", "fear", "panic", "distress", "neutral", "calm", "contempt", "submission", "grief", "confusion", "defiance", "shame", "desperation"]
# Other words for emotions.
EMOTION_ALIASES = [
    ("relaxed", "calm"), ("peaceful", "calm"), ("tense", "distress"), ("worried", "distress"), ("anxious", "distress"),
    ("desperate", "desperation"), ("pleading", "desperation"), ("begging", "desperation"), ("helpless", "submission"), ("resigned", "submission"),
    ("sad", "grief"), ("sorrowful", "grief"), ("angry", "anger"), ("frustrated", "anger"), ("aggressive", "anger"),
    ("rage", "anger"), ("furious", "anger"), ("threatening", "contempt"), ("shocked", "panic"), ("fearful", "fear"),
    ("afraid", "fear"), ("scared", "fear"), ("terrified", "fear"), ("panicked", "panic"), ("panicking", "panic"),
    ("distressed", "distress"), ("uncertain", "confusion"), ("confused", "confusion"), ("lost", "confusion"), ("defiant", "defiance"),
    ("ashamed", "shame"), ("shameful", "shame"), ("submissive", "submission"), ("contemptuous", "contempt"), ("grieving", "grief"),
    ("happy", "neutral"), ("content", "neutral"),
]
# Role, intensity -> rate, pitch (semitones), volume (dB) that a speaker drifts to; other roles stay at 1, 0, 0.
DRIFT_TARGETS = [
    ("AGG", 1, 1.00, 0.0, 0.0), ("AGG", 2, 1.03, 0.2, 1.0), ("AGG", 3, 1.08, 0.5, 2.0), ("AGG", 4, 1.12, 1.0, 3.0), ("AGG", 5, 1.15, 1.5, 4.0),
    ("VIC", 1, 1.00, 0.0, 0.0), ("VIC", 2, 0.98, 0.1, -0.5), ("VIC", 3, 0.94, 0.3, -1.5), ("VIC", 4, 0.90, 0.5, -2.5), ("VIC", 5, 0.87, 0.7, -3.0),
]
# A victim's breathiness by intensity.
BREATHINESS = [0.0, 0.0, 0.33, 0.67, 1.0]
# Fixed values: (previous role, role, intensity) -> chances of a barge-in and of an overlap.
OVERLAP_CHANCES = [
    ("VIC", "AGG", 1, 0.02, 0.05), ("VIC", "AGG", 2, 0.05, 0.08), ("VIC", "AGG", 3, 0.10, 0.15), ("VIC", "AGG", 4, 0.25, 0.20), ("VIC", "AGG", 5, 0.40, 0.15),
    ("AGG", "VIC", 1, 0.05, 0.10), ("AGG", "VIC", 2, 0.05, 0.10), ("AGG", "VIC", 3, 0.05, 0.10), ("AGG", "VIC", 4, 0.05, 0.10), ("AGG", "VIC", 5, 0.05, 0.10),
]
# Context -> shortest and longest gap in seconds.
GAPS = [("vic_low", 0.3, 0.6), ("vic_i3", 0.15, 0.35), ("vic_i4", 0.05, 0.15), ("vic_i5", 0.1, 0.3), ("agg_low", 0.2, 0.5), ("agg_high", 0.05, 0.2), ("agg_pause", 0.6, 1.4)]
# The same of the second project.
GAPS_2 = [("vic_low", 0.25, 0.5), ("vic_i3", 0.1, 0.3), ("vic_i4", 0.05, 0.1), ("vic_i5", 0.08, 0.2), ("agg_low", 0.15, 0.4), ("agg_high", 0.05, 0.15), ("agg_pause", 0.5, 1.2)]
BARGE_IN_DEPTH, OVERLAP_DEPTH, PAUSE_CHANCE = (0.20, 0.50), (0.10, 0.35), 0.30


def frame(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A dimension of a few rows, fit for broadcast."""
    return F.broadcast(spark.createDataFrame(rows, columns))


def values(rows: list[tuple], columns: str) -> str:
    """The same dimension as a SQL subquery."""
    literal = lambda v: f"'{v}'" if isinstance(v, str) else repr(v) if isinstance(v, int) else f"CAST({v} AS DOUBLE)"
    return "(SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({columns}))"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
