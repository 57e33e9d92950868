"""Toxicity by a weighted finite-state pattern grammar.

Small transducers read a text in three steps. Over letters, a lexicon gives each word its class (an insult's stem, a
violent verb, the speaker, an intention, someone addressed, a negation, a report) and passes other words unchanged. Over
the classes of a clause, insult and threat make kinds of them (a violent verb is a threat after the speaker or an
intention, else it is only violence), and negation, reported speech and target mark the kinds: is it negated, only
reported, aimed at someone? These five are composed into one. What is aimed at may stand on either side, so the target
transducer also reads the marked clause backwards. Matched clauses rather than isolated words are what a document is
scored on. The stems are learned from labelled documents; the other words are fixed lists; the weight of each pattern is
learned by a logistic regression. Labels come from a bounded sample (`max_labelled` rows, chosen by a hash of doc_id);
what is learned is therefore small and goes to every task; all documents are then scored in one pass without a shuffle.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from showbill.llm.common import settle, slices

# Fixed word lists of the grammar, English, German, French and Spanish.
VERBS = "kill murder hurt destroy strangle stab shoot töten umbringen verletzen vernichten tuer frapper détruire matar herir destruir".split()
SPEAKERS = "i we i'll we'll i'm ich wir je nous yo nosotros".split()
INTENTIONS = "will shall gonna going must should werde werden wird vais allons voy vamos".split()
TARGETS = "you your yours yourself u you're dich dir du euch ihr dein deine tu toi te vous ton votre tú ti tu te usted ustedes os".split()
NEGATIONS = "not no never nobody isn't aren't don't won't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says told called quoted quote wrote claimed sagte sagt nannte schrieb dit disait écrit appelé dijo dice llamó escribió".split()

CLAUSE_END = re.compile(r"[.,;:!?\n|()\"]")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
STEM, VERB, SPEAKER, INTENTION, TARGET, NEGATION, REPORT = "stem", "verb", "speaker", "intention", "target", "negation", "report"
INSULT, THREAT, VIOLENCE = "insult", "threat", "violence"
CLASSES = {STEM, VERB, SPEAKER, INTENTION, TARGET, NEGATION, REPORT}
END = "</word>"


@dataclass
class Transducer:
    """States from 0; arcs map (state, symbol) to (state, output). Without an arc a symbol passes unchanged, to `other` of the state or else to the state itself."""

    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)
    states: int = 1
    other: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or (self.other.get(state, state), symbol)

    def run(self, symbols: list[str]) -> list[str]:
        state, out = 0, []
        for s in symbols:
            state, said = self.step(state, s)
            out.append(said)
        return out

    def compose(self, after: Transducer, symbols: set[str]) -> Transducer:
        """The transducer that feeds this one's output to `after`; symbols: what the first may read."""
        arcs = {}
        for a in range(self.states):
            for b in range(after.states):
                for s in symbols:
                    a2, mid = self.step(a, s)
                    b2, out = after.step(b, mid)
                    arcs[a * after.states + b, s] = (a2 * after.states + b2, out)
        return Transducer(arcs, self.states * after.states)


def lexicon(stems: list[str]) -> Transducer:
    """Letters of a word and END to the word's class, given out at END. A stem that ends in $ is a whole word, others are beginnings."""
    t, rest = Transducer(), []
    t.states, t.other = 3, {0: 2, 1: 1, 2: 2}  # 1: inside a word that begins with a stem; 2: inside an unknown word
    t.arcs[1, END] = (0, STEM)

    def path(word: str) -> int:
        state = 0
        for c in word:
            if (state, c) not in t.arcs:
                t.arcs[state, c] = (t.states, "")
                t.other[t.states] = 2
                t.states += 1
            state = t.arcs[state, c][0]
        return state

    for words, name in ((VERBS, VERB), (SPEAKERS, SPEAKER), (INTENTIONS, INTENTION), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
        for w in words:
            t.arcs[path(w), END] = (0, name)
    for s in stems:
        state = path(s.removesuffix("$"))
        t.arcs[state, END] = (0, STEM)
        if not s.endswith("$"):
            rest.append(state)
    # What goes on after a beginning is still the stem, whatever other words share its letters.
    longer: dict[int, list[int]] = {}
    for (start, c), (end, _) in t.arcs.items():
        if c != END:
            longer.setdefault(start, []).append(end)
    below = list(rest)
    while below:
        state = below.pop()
        t.arcs[state, END], t.other[state] = (0, STEM), 1
        below += longer.get(state, [])
    return t


def insults() -> Transducer:
    return Transducer({(0, STEM): (0, INSULT)})


def threats() -> Transducer:
    """A violent verb is a threat once the speaker or an intention was read, else violence."""
    t = Transducer({(0, VERB): (0, VIOLENCE), (1, VERB): (1, THREAT)}, 2)
    for s in (SPEAKER, INTENTION):
        t.arcs[0, s] = t.arcs[1, s] = (1, s)
    return t


def flagger(trigger: str, mark: str, kinds: list[str], once: bool) -> Transducer:
    """Once the trigger was read, marks every later kind in the clause; with once, only the first one after it."""
    t = Transducer({(0, trigger): (1, trigger), (1, trigger): (1, trigger)}, 2)
    for k in kinds:
        t.arcs[1, k] = (0 if once else 1, f"{k}+{mark}")
    return t


KINDS = [INSULT, THREAT, VIOLENCE]
NEGATED = [*KINDS, *(f"{k}+not" for k in KINDS)]
REPORTED = [*NEGATED, *(f"{k}+said" for k in NEGATED)]


def grammar() -> tuple[Transducer, Transducer]:
    """insult, threat, negation, report and target, composed; and the target transducer that then reads the clause backwards."""
    t = insults()
    for after in (threats(), flagger(NEGATION, "not", KINDS, True), flagger(REPORT, "said", NEGATED, False), flagger(TARGET, "aimed", REPORTED, False)):
        t = t.compose(after, CLASSES)
    return t, flagger(TARGET, "aimed", REPORTED, False)


#: Every pattern that the grammar can give out; a document's features are how many of its clauses match each.
PATTERNS = [*REPORTED, *(f"{k}+aimed" for k in REPORTED)]
PLACE = {p: i for i, p in enumerate(PATTERNS)}
MOST = 4


class Matcher:
    """Pattern counts of a text for a given list of insult stems. A stem that ends in $ is a whole word."""

    def __init__(self, stems: list[str]):
        import ahocorasick

        self.lexicon, (self.onward, self.backward) = lexicon(stems), grammar()
        self.class_of: dict[str, str] = {}
        # Clauses without a stem or a violent verb match no pattern and aren't read.
        self.triggers = ahocorasick.Automaton()
        for s in [*(s.removesuffix("$") for s in stems), *VERBS]:
            self.triggers.add_word(s, len(s))
        self.triggers.make_automaton()

    def kind(self, word: str) -> str:
        got = self.class_of.get(word)
        if got is None:
            got = self.lexicon.run([*word, END])[-1]
            if len(self.class_of) < 50_000:
                self.class_of[word] = got
        return got

    def patterns(self, clause: list[str]) -> set[str]:
        """The patterns of a clause's words."""
        marked = self.onward.run([k for k in map(self.kind, clause) if k in CLASSES])
        return PLACE.keys() & set(self.backward.run(marked[::-1]))

    def counts(self, text: str | None) -> list[int]:
        found = [0] * len(PATTERNS)
        low = (text or "").lower()
        at = -1
        for end, n in self.triggers.iter(low):
            start = end - n + 1
            if start < at or (start and low[start - 1].isalnum()):
                continue  # inside a clause that was read already, or inside a word
            before = max(low.rfind(c, 0, start) for c in '.,;:!?\n|()"') + 1
            stop = CLAUSE_END.search(low, end)
            at = stop.start() if stop else len(low)
            for p in self.patterns(WORD.findall(low, before, at)):
                found[PLACE[p]] += 1
        return found


@dataclass
class Model:
    stems: list[str]
    weights: list[float]
    bias: float


def stem_counts(labelled: DataFrame) -> DataFrame:
    """stem, toxic and clean: in how many labelled documents each beginning of a word (3 to 12 letters, or a whole word and $) occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            tally = (Counter(), Counter())
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                stems = set()
                for w in set(WORD.findall((text or "").lower())):
                    stems.update(w[:n] for n in range(3, min(len(w), 12) + 1))
                    stems.add(f"{w}$")
                tally[1 if toxic else 0].update(stems)
            stems = list(tally[0] | tally[1])
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([tally[1][s] for s in stems], pa.int64()), pa.array([tally[0][s] for s in stems], pa.int64())], ["stem", "toxic", "clean"])

    return labelled.select("text", "toxic").mapInArrow(run, "stem string, toxic bigint, clean bigint").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_stems(support: dict[str, int]) -> list[str]:
    """Of stems that tell toxic texts, with the number of toxic texts each: the shortest, each grown as long as it keeps its texts."""
    children: dict[str, list[str]] = {}
    for s in support:
        children.setdefault(s[:-1], []).append(s)
    chosen = []
    for s in sorted(support):
        if s[:-1] in support:
            continue
        while longer := [c for c in children.get(s, []) if support[c] >= 0.97 * support[s]]:
            s = max(longer, key=lambda c: (support[c], c))
        chosen.append(s)
    return sorted(set(chosen))


def stem_hits(stems: list[str]):
    """For each text, the places in `stems` of those that it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {s: i for i, s in enumerate(stems)}
        for b in slices(batches):
            hits = []
            for text in b.column("text").to_pylist():
                words = set(WORD.findall((text or "").lower()))
                hits.append(sorted({place[s] for w in words for s in (f"{w}$", *(w[:n] for n in range(3, 13))) if s in place}))
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32()))], ["hits"])

    return run


def cover(hits: list[list[int]], least: int) -> set[int]:
    """Greedily the stems that tell most texts not yet told by chosen ones, while a stem tells at least `least` of them.

    Words that toxic texts share only because they are copies of each other explain nothing that an insult doesn't.
    """
    holders: dict[int, list[int]] = {}
    for text, stems in enumerate(hits):
        for s in stems:
            holders.setdefault(s, []).append(text)
    tells = {s: len(texts) for s, texts in holders.items()}
    # Counts only fall, so a stem whose count still holds when it comes up tells most.
    queue = [(-n, s) for s, n in tells.items()]
    heapq.heapify(queue)
    chosen, told = set(), [False] * len(hits)
    while queue and -queue[0][0] >= least:
        n, s = heapq.heappop(queue)
        if tells[s] != -n:
            heapq.heappush(queue, (-tells[s], s))
            continue
        chosen.add(s)
        for text in holders[s]:
            if not told[text]:
                told[text] = True
                for other in hits[text]:
                    tells[other] -= 1
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 60) -> tuple[list[float], float]:
    """Ridge-regularised logistic regression by Newton steps; the bias is unregularised."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (p - y) + penalty @ w
        step = np.linalg.solve(x1.T @ (x1 * (p * (1 - p) + 1e-9)[:, None]) + penalty, gradient)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def features(stems: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Matcher(stems)
        for b in slices(batches):
            counts = [own.counts(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(counts, pa.list_(pa.int32()))], ["toxic", "counts"])

    return run


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, least: int = 4, times: float = 20.0) -> Model:
    """Learns from labels (doc_id, toxic), of which at most max_labelled are used, chosen by a hash of doc_id.

    A stem is learned if at least `least` toxic documents hold it and its share of them is `times` that of clean
    ones. All such stems are candidates, of which a greedy cover of the toxic texts is kept: a group of copies is told by
    one stem, however many words it shares. Rows with a null label or doc_id are left out; of repeated labels
    the largest counts. Without toxic or without clean labels the model has no stems and scores by the share of labels.
    """
    one = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = settle(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    labelled = settle(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic"))
    n = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sum(v for k, v in n.items() if k), n.get(0, 0)
    if not toxic or not clean:
        return Model([], [0.0] * len(PATTERNS), 3.0 if toxic and not clean else -3.0)
    share = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    telling = stem_counts(labelled).where(F.col("toxic") >= least).where(share >= times).where("20 * clean < toxic")
    rows = telling.select("stem", "toxic").toArrow()
    stems = choose_stems(dict(zip(rows["stem"].to_pylist(), rows["toxic"].to_pylist(), strict=True)))
    hits = labelled.where("toxic > 0").select("text").mapInArrow(stem_hits(stems), "hits array<int>").toArrow()["hits"].to_pylist()
    stems = [stems[i] for i in sorted(cover(hits, least))]
    seen = labelled.mapInArrow(features(stems), "toxic int, counts array<int>").collect()
    x = np.minimum(np.array([r["counts"] for r in seen], dtype=float), MOST)
    weights, bias = logistic(x, np.array([float(bool(r["toxic"])) for r in seen]))
    return Model(stems, weights, bias)


def score(docs: DataFrame, model: Model, out: str = "tox_score") -> DataFrame:
    """The columns of docs and `out` (0 to 1; it replaces a column of that name). Null and empty texts get the score of a text without matches."""
    names = [c for c in docs.columns if c != out]
    weights = np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Matcher(model.stems)
        for b in slices(batches):
            counts = np.array([own.counts(t) for t in b.column("text").to_pylist()], dtype=float).reshape(-1, len(PATTERNS))
            p = 1 / (1 + np.exp(-np.clip(np.minimum(counts, MOST) @ weights + model.bias, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], [*names, out])

    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(out, DoubleType())]))


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learned from; a null doc_id isn't one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return learn(docs, labels.where(~held_out()))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted."""
    scored = score(docs.select("doc_id", "text"), trained(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below 0.5, with the columns of docs, whatever their names. Labels that teach no stem reject nothing."""
    out, model = "_tox_score" + "_" * max(map(len, docs.columns)), trained(docs, labels)
    if not model.stems:
        return docs
    return score(docs, model, out).where(F.col(out) < 0.5).drop(out)
