"""Text functions on columns."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from auralith.hebrew import AMBIGUOUS, PAUSES


def normalised(text: Column) -> Column:
    """Other than letters, digits, underscores, white space and Hebrew becomes a space; spaces collapse. Unicode classes."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\s\x{0590}-\x{05FF}]", " "), r"(?U)\s+", " "))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, " "), lambda w: w != ""))


def length_ratio(hypothesis: Column, reference: Column) -> Column:
    """Words of the hypothesis for each of the reference, which counts as one at least."""
    return word_count(hypothesis) / F.greatest(word_count(reference), F.lit(1))


def most_repeated_trigram(text: Column) -> Column:
    """How often the most frequent run of three words occurs; 0 for fewer than three words. Sorted in the row, without a shuffle."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    grams = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.array_join(F.slice(words, i, 3), " ")))
    longest = F.aggregate(grams, F.struct(F.lit("").alias("g"), F.lit(0).alias("n"), F.lit(0).alias("most")), lambda a, g: F.struct(g.alias("g"), F.when(a["g"] == g, a["n"] + 1).otherwise(1).alias("n"), F.greatest(a["most"], F.when(a["g"] == g, a["n"] + 1).otherwise(1)).alias("most")), lambda a: a["most"])
    return F.when(F.size(words) < 3, 0).otherwise(longest)


def plain_hebrew(text: Column) -> Column:
    """Without vowel signs and direction marks, final letters as others, punctuation as spaces, spaces collapsed."""
    bare = F.regexp_replace(text, r"[\x{0591}-\x{05BD}\x{05BF}\x{05C1}\x{05C2}\x{05C4}-\x{05C7}\x{202A}-\x{202E}\x{200E}\x{200F}]", "")
    plain = F.regexp_replace(F.translate(bare, "ךםןףץ", "כמנפצ"), r"""[.,!?;:"'()\[\]\-–—…״׳]""", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def direction_marks(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\x{202A}-\x{202E}\x{200E}\x{200F}]"))


def hallucination_signals(reference: Column, hypothesis: Column) -> list[Column]:
    """T5: length_ratio, hyp_repeat, ref_repeat, repeat_ratio, rtl_marks (of the text as it is)."""
    ref, hyp = plain_hebrew(reference), plain_hebrew(hypothesis)
    a, b = most_repeated_trigram(hyp), most_repeated_trigram(ref)
    return [length_ratio(hyp, ref).alias("length_ratio"), a.alias("hyp_repeat"), b.alias("ref_repeat"), (a / F.greatest(b, F.lit(1))).alias("repeat_ratio"), direction_marks(hypothesis).alias("rtl_marks")]


def char_error_rate(reference: Column, hypothesis: Column) -> Column:
    """T4: edits of characters for each of the reference."""
    return F.levenshtein(reference, hypothesis) / F.greatest(F.length(reference), F.lit(1))


def word_edits(reference: str | None, hypothesis: str | None) -> tuple[int, int, int]:
    """T4: edits between the words, words of the reference and of the hypothesis; for map_rows."""
    a, b = (reference or "").split(), (hypothesis or "").split()
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1], len(a), len(b)


def disfluent(text: Column, chance: float, draw: Callable[[Column], Column]) -> Column:
    """Filled pauses between sentences with a chance each; draw: position -> number in [0, 1)."""
    parts = F.split(F.trim(text), r"(?<=[.!?])\s+")
    pause = lambda i: F.get(F.array(*[F.lit(p) for p in PAUSES]), F.floor(draw(i * 2 + 1) * len(PAUSES)).cast("int"))
    joined = F.transform(parts, lambda p, i: F.when((i > 0) & (draw(i * 2) < chance), F.concat(pause(i), F.lit(" "), p)).otherwise(p))
    return F.when(F.size(parts) <= 1, text).otherwise(F.array_join(joined, " "))


HEBREW = r"[\x{0591}-\x{05C7}\x{05D0}-\x{05EA}]"


def disambiguated(text: Column, gender: Column) -> tuple[Column, Column]:
    """The text with vowels where the spelling hides the addressee's gender, and the rules that were used, in order; as it is for other genders."""
    out, rules = text, []
    for rule, spelling, female, male in AMBIGUOUS:
        pattern = f"(?<!{HEBREW}){spelling}(?!{HEBREW})"
        used = gender.isin("female", "male") & out.rlike(pattern)
        rules.append(F.when(used, F.concat(F.when(gender == "female", "F2_").otherwise("M2_"), F.lit(rule))))
        out = F.regexp_replace(out, F.lit(pattern), F.when(gender == "female", female).when(gender == "male", male).otherwise(spelling))
    return out, F.array_compact(F.array(*rules))


def ambiguities(text: Column) -> Column:
    """The spellings that still hide a gender, as they occur."""
    spellings = "|".join(sorted((s for _, s, *_ in AMBIGUOUS), key=len, reverse=True))
    return F.regexp_extract_all(text, F.lit(f"(?<!{HEBREW})(?:{spellings})(?!{HEBREW})"), 0)


TURNS = "turns array<struct<speaker_id:string,text:string,intensity:int,pause_before_s:double,emotional_state:string,phrase_hints:array<struct<phrase_id:string,hint:string,char_start_original:int,char_end_original:int>>>>"


def response_turns(raw: Column) -> Column:
    """The turns of an answer in JSON, in a code fence or bare, with the defaults of missing fields; hints that lack a field are left out. Null where it doesn't parse."""
    fenced = F.regexp_extract(raw, r"```(?:json)?\s*([\s\S]+?)```", 1)
    turns = F.from_json(F.when(fenced != "", F.trim(fenced)).otherwise(F.trim(raw)), TURNS).getField("turns")
    whole = lambda h: h["phrase_id"].isNotNull() & h["hint"].isNotNull() & h["char_start_original"].isNotNull() & h["char_end_original"].isNotNull()
    return F.transform(turns, lambda t: F.struct(
        t["speaker_id"].alias("speaker_id"), t["text"].alias("text"), F.coalesce(t["intensity"], F.lit(1)).alias("intensity"), F.coalesce(t["pause_before_s"], F.lit(0.3)).alias("pause_before_s"),
        F.coalesce(t["emotional_state"], F.lit("neutral")).alias("emotional_state"), F.coalesce(F.filter(t["phrase_hints"], whole), F.array()).alias("phrase_hints")))


def voice_name(ssml: Column) -> Column:
    """T14."""
    return F.regexp_extract(ssml, r"""<voice[^>]*\bname=["']([^"']+)["']""", 1)


def transcript_lines(speaker: Column, role: Column, onset: Column, offset: Column, text: Column, action: Column, intensity: Column) -> Column:
    """A turn's lines of a transcript."""
    head = F.format_string("[SPEAKER: %s | ROLE: %s | ONSET: %.2f | OFFSET: %.2f]", speaker, role, onset, offset)
    return F.array_join(F.array(head, text, F.format_string("[ACTION: %s | INTENSITY: %d]", action, intensity)), "\n")


def script_key(columns: list[str]) -> Column:
    """H1: the hash of the fields in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
