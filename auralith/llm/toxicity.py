"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, reported-speech cue, other). Small transducers mark what a negation, a reporting cue
or a target does to the words after it, and the last ones weigh insults and threats as marked; their composition is one table, computed
once, and a clause is scored by one walk through it. Isolated words get little: insults weigh more when aimed at a target, less when
negated or reported; threats count only with a target.

Insult words are a short fixed list of four languages and, for all others, words and word beginnings learned from labelled texts: those that
toxic texts hold far more often than chance allows (binomial tail, corrected for the number of candidates). The clause scores of a text
are calibrated by logistic regression; lexicon and calibration use different halves of the sample.

The fit takes at most FIT_ROWS labelled documents (chosen by a hash of doc_id, outside the held-out part), whole texts; it doesn't grow with
the corpus. Cases: null and empty texts have no clause and get the score of none; very long clauses are walked once; repeated rows score
alike; without labels of both kinds the fixed words alone are used and the calibration is the smoothed rate; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auralith.llm.calibration import fit_logistic, sigmoid
from auralith.llm.common import crc_rest, fitted, labelled_sample, map_texts

FIT_ROWS = 2000
THRESHOLD = 0.3
#: Lengths of learned word beginnings; the least toxic texts that show one.
LENGTHS, SEEN = range(3, 9), 4
INSULTS = "idiot moron clown loser scum trash pathetic worthless stupid disgusting imbécil estúpido basura asqueroso dummkopf abschaum widerlich wertlos crétin ordure dégoûtant minable".split()
THREATS = "kill hurt destroy burn beat crush smash matar golpear destruir quemar töten schlagen zerstören verbrennen tuer frapper détruire brûler".split()
TARGETS = "you your yours they them he him she her tú usted ustedes vosotros du dich dir ihr euch tu toi vous ils elles".split()
NEGATIONS = "not never no isn't aren't don't won't nicht nie kein keine niemals ne pas jamais nunca jamás".split()
REPORTS = "said says told quoted reported wrote claimed dijo dice escribió sagte sagt schrieb berichtet dit disait écrit rapporte".split()

INSULT, WEAK, THREAT, TARGET, NEGATION, REPORT, OTHER = "I", "J", "H", "T", "N", "R", "O"


@dataclass
class Transducer:
    """(state, symbol) -> (state, symbol out, weight); what is missing stays in its state and passes with weight 0. State 0 is the start."""

    moves: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def move(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.moves.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """first's output read by second, over the reachable pairs of states; weights add up."""
    symbols = [*symbols]
    number, queue, out = {(0, 0): 0}, [(0, 0)], Transducer()
    while queue:
        pair = queue.pop()
        for symbol in symbols:
            a, between, w = first.move(pair[0], symbol)
            b, last, v = second.move(pair[1], between)
            if (a, b) not in number:
                number[a, b] = len(number)
                queue.append((a, b))
            out.moves[number[pair], symbol] = (number[a, b], last, w + v)
    return out


def negation() -> Transducer:
    """A negation marks an insult or threat among the next two words with '-'."""
    moves = {}
    for state in range(3):
        moves[state, NEGATION] = (2, NEGATION, 0.0)
        for symbol in (INSULT, WEAK, THREAT):
            moves[state, symbol] = (max(0, state - 1), symbol + "-" * (state > 0), 0.0)
        for symbol in (TARGET, OTHER, REPORT):
            moves[state, symbol] = (max(0, state - 1), symbol, 0.0)
    return Transducer(moves)


def reported() -> Transducer:
    """After a reporting cue, insults and threats up to the end of the clause are marked with '~'."""
    return Transducer({(0, REPORT): (1, REPORT, 0.0)} | {(1, s + n): (1, s + n + "~", 0.0) for s in (INSULT, WEAK, THREAT) for n in ("", "-")})


def targeted() -> Transducer:
    """After a target, insults and threats are marked with '>'; a target that follows an insult or threat is marked itself."""
    marked = [s + n + r for s in (INSULT, WEAK, THREAT) for n in ("", "-") for r in ("", "~")]
    moves = {(0, TARGET): (1, TARGET, 0.0), (2, TARGET): (1, TARGET + "<", 0.0), (3, TARGET): (1, TARGET + "<<", 0.0)}
    for symbol in marked:
        moves[0, symbol] = (3 if symbol[0] == THREAT else 2, symbol, 0.0)
        moves[2, symbol] = (3 if symbol[0] == THREAT else 2, symbol, 0.0)
        moves[3, symbol] = (3, symbol, 0.0)
        moves[1, symbol] = (1, symbol + ">", 0.0)
    return Transducer(moves)


def insults() -> Transducer:
    """Weighs marked insults: a reported or negated one keeps a part of its weight, a target adds to the others."""
    moves = {(0, TARGET + "<"): (0, OTHER, 0.5)}
    for symbol, base in ((INSULT, 1.0), (WEAK, 0.6)):
        for n in ("", "-"):
            for r in ("", "~"):
                for t in ("", ">"):
                    moves[0, symbol + n + r + t] = (0, OTHER, base * (0.3 if n else 1) * (0.5 if r else 1) + (0.5 if t and not n and not r else 0))
    return Transducer(moves)


def threats() -> Transducer:
    """Weighs marked threats; without a target they are words like others."""
    moves = {(0, TARGET + "<<"): (0, OTHER, 1.5)}
    for n in ("", "-"):
        for r in ("", "~"):
            moves[0, THREAT + n + r + ">"] = (0, OTHER, 1.5 * (0.2 if n else 1) * (0.5 if r else 1))
    return Transducer(moves)


def grammar() -> Transducer:
    out = negation()
    for part in (reported(), targeted(), insults(), threats()):
        out = compose(out, part, [INSULT, WEAK, THREAT, TARGET, NEGATION, REPORT, OTHER])
    return out


TABLE = grammar()
FIXED = {w: s for s, words in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}
_words = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?").finditer
_ends = re.compile(r"[.!?;\n]")


@dataclass(frozen=True)
class Model:
    """units: (word or beginning, whether it is a beginning, symbol); weights: of the calibration."""

    units: tuple[tuple[str, bool, str], ...]
    weights: tuple[float, ...]


@lru_cache(4)
def _automaton(units: tuple[tuple[str, bool, str], ...]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word in (*INSULTS, *THREATS):
        out.add_word(word, (len(word), False, FIXED[word]))
    for unit, beginning, symbol in units:
        out.add_word(unit, (len(unit), beginning, symbol))
    out.make_automaton()
    return out


def clause_scores(text: str, units: tuple[tuple[str, bool, str], ...]) -> list[float]:
    """The scores of the clauses that hold an insult or threat word."""
    low = text.lower()
    n, found = len(low), {}
    for end, (length, beginning, symbol) in _automaton(units).iter(low):
        start = end + 1 - length
        if (start == 0 or not low[start - 1].isalpha()) and (beginning or end + 1 == n or not low[end + 1].isalpha()):
            found.setdefault(start, symbol)
    out, done = [], -1
    for at in sorted(found):
        if at < done:
            continue
        start = max(low.rfind(c, 0, at) for c in ".!?;\n") + 1
        stop = _ends.search(low, at)
        done = stop.start() if stop else n
        state, total = 0, 0.0
        for m in _words(low, start, done):
            symbol = found.get(m.start()) or FIXED.get(m[0], OTHER)
            state, _, w = TABLE.moves[state, symbol]
            total += w
        out.append(total)
    return out


def features(text: str, units: tuple[tuple[str, bool, str], ...]) -> list[float]:
    """Sum and maximum of the clause scores (with falling gains), and the sum for each hundred characters' worth of clauses."""
    scores = clause_scores(text, units)
    total = sum(scores)
    return [math.log1p(total), min(max(scores, default=0.0), 4.0), min(100 * total / (len(text) + 100), 4.0)]


def families(rows: list[tuple[str, int]]) -> list[tuple[set[str], int]]:
    """The words of each text, without those that share 40 % of their long words with an earlier one of like size: copies would count as chance can't."""
    owner: dict[str, int] = {}
    sizes, out = [], []
    for text, y in rows:
        words = {m[0] for m in _words(text.lower())} - FIXED.keys()
        long = [w for w in words if len(w) > 5]
        at, same = max(Counter(owner[w] for w in long if w in owner).items(), key=lambda x: x[1], default=(0, 0))
        if long and same >= 0.4 * max(len(long), sizes[at] if same else 0):
            continue
        for w in long:
            owner.setdefault(w, len(sizes))
        sizes.append(len(long))
        out.append((words, y))
    return out


def learn_units(texts: list[tuple[set[str], int]]) -> tuple[tuple[str, bool, str], ...]:
    """Words and beginnings whose toxic texts outnumber chance, the most telling first; what begins like one that is taken, or one's beginning, is left out.

    A beginning must have been seen in several words. texts: words and labels, from families.
    """
    n_bad = sum(y for _, y in texts)
    n_good = len(texts) - n_bad
    if not n_bad or not n_good:
        return ()
    chance = math.log(n_bad / len(texts))
    parts = lambda w: [(w, False), *((w[:k], True) for k in LENGTHS if k < len(w))]
    bad, good = Counter(), Counter()
    forms: dict[str, set[str]] = {}
    for words, y in texts:
        if y:
            bad.update({p for w in words for p in parts(w)})
    bad = Counter({p: n for p, n in bad.items() if n >= SEEN})
    # what couldn't be taken even if no clean text had it
    least = (math.log(0.1) - math.log(max(1, len(bad)))) / chance
    seen, candidates = {p: n for p, n in bad.items() if n >= least}, max(1, len(bad))
    del bad
    for words, y in texts:
        found = set()
        for w in words:
            own = [p for p in parts(w) if p in seen]
            found.update(own)
            if y:
                for unit, beginning in own:
                    if beginning:
                        forms.setdefault(unit, set()).add(w)
        if not y:
            good.update(found)
    rate, ranked = n_bad / len(texts), []
    for p, t in seen.items():
        c = good[p]
        if p[1] and len(forms[p[0]]) < SEEN:
            continue
        terms = [math.lgamma(t + c + 1) - math.lgamma(k + 1) - math.lgamma(t + c - k + 1) + k * math.log(rate) + (t + c - k) * math.log1p(-rate) for k in range(t, t + c + 1)]
        top = max(terms)
        tail = top + math.log(sum(math.exp(x - top) for x in terms))
        odds = math.log((t + 0.5) / (n_bad + 1)) - math.log((c + 0.5) / (n_good + 1))
        if tail + math.log(candidates) < math.log(0.1) and odds > 3.3:
            ranked.append((tail, -len(p[0]), p, c / (t + c)))
    taken: dict[str, tuple[str, bool, str]] = {}
    beginnings: set[str] = set()
    for _, _, (unit, beginning), dirt in sorted(ranked):
        if unit in beginnings or any(unit[:k] in taken for k in range(1, len(unit) + 1)):
            continue
        taken[unit] = (unit, beginning, INSULT if dirt < 0.05 else WEAK)
        beginnings.update(unit[:k] for k in range(1, len(unit) + 1))
    return tuple(sorted(taken.values()))


def train(rows: list[tuple[str, int]]) -> Model:
    """Each half's features come from the units of the other half; the units that stay come from both."""
    rows = sorted(rows)  # the fit does not depend on the order of its rows
    halves = rows[::2], rows[1::2]
    texts = families(halves[0]), families(halves[1])
    x, y = [], []
    for own, other in (halves[0], texts[1]), (halves[1], texts[0]):
        units = learn_units(other)
        x += [features(t, units) for t, _ in own]
        y += [k for _, k in own]
    weights = fit_logistic(np.array(x, float).reshape(-1, 3), np.array(y, float), ridge=1e-2)
    return Model(learn_units(families(rows)), tuple(weights.tolist()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    return fitted(labelled_sample(docs, labels, "toxic", crc_rest("doc_id", 4) == 2, rows), train)


def scores(texts: list[str], model: Model) -> np.ndarray:
    x = np.array([features(t, model.units) for t in texts], float).reshape(-1, 3)
    return sigmoid(model.weights[0] + x @ np.array(model.weights[1:]))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Appends the score of each whole text."""
    return map_texts(docs, "text", f"{name} double", lambda texts: [pa.array(scores(texts, model), pa.float64())])


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    held = F.coalesce(crc_rest("doc_id", 4) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of the documents with a score below the threshold; the fit reads the documents that are still there."""
    return score(docs.select(*columns), fit(docs, labels), "__score").where(F.col("__score") < THRESHOLD).select(*columns)
