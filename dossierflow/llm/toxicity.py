"""Toxicity by a lexicon matched with bounded edits, and by where matches stand.

Terms are words and word beginnings learned from labelled texts. Their trie is
intersected with a Levenshtein automaton: states are (trie node, edits left),
made deterministic once, so that one table look-up per character matches a word
against all terms with their misspellings. All words of many texts step
through the table together. Each match is judged in its context window: inside
quotation marks or after a word that reports speech it counts as quoted, else as
said, and the share of matches in the densest window is a feature too. A
logistic model turns these features into a score; it also learns from training
texts whose terms are misspelled (as toxic as before) and from clean ones that
quote terms (as clean as before), and its weights have the signs that these mean.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, narrow, packed, same, text_chunks, written

CHUNK_BYTES = 2_000_000
#: Words before a match that are searched for quotation, and the window of density.
CONTEXT, WINDOW = 5, 20
MAX_STATES = 200_000
FEATURES = ("said", "said_rate", "fuzzy", "fuzzy_rate", "quoted", "quoted_rate", "density")
#: What a match said can only add, and one quoted only take away.
SIGNS = (1, 1, 1, 1, -1, -1, 1)

#: Words that report speech.
REPORTING = (
    "said", "says", "quote", "quoted", "called", "wrote", "word", "term", "sagte", "schrieb", "wort", "dit", "mot",
    "dijo", "palabra",
)


@dataclass(frozen=True)
class Term:
    text: str
    prefix: bool  # matches any word that begins so
    edits: int


class Automaton:
    """``table[state, character class]``; state 0 is dead, 1 the start. ``accept[state]``
    at a word's end: 0 no match, 1 exact, 2 with edits."""

    def __init__(self, terms: list[Term]):
        alphabet = sorted({c for t in terms for c in t.text})
        self.classes = {c: i + 1 for i, c in enumerate(alphabet)}  # 0: all others
        children: list[dict[str, int]] = []
        ends: list[int] = []  # 0 none, 1 word, 2 prefix

        def node() -> int:
            children.append({})
            ends.append(0)
            return len(children) - 1

        roots: dict[int, int] = {}
        for term in sorted(terms, key=lambda t: (t.edits, t.text)):
            if term.edits not in roots:
                roots[term.edits] = node()
            at = roots[term.edits]
            for c in term.text:
                if c not in children[at]:
                    children[at][c] = node()
                at = children[at][c]
            ends[at] = max(ends[at], 2 if term.prefix else 1)

        def close(states: set[tuple[int, int, int]]) -> frozenset:
            """Add what missing characters reach. A state is (node, edits left, edits made)."""
            todo = list(states)
            while todo:
                n, left, made = todo.pop()
                if left and ends[n] != 2:
                    for child in children[n].values():
                        if (s := (child, left - 1, made + 1)) not in states:
                            states.add(s)
                            todo.append(s)
            return frozenset(states)

        def step(states: frozenset, c: str) -> frozenset:
            out = set()
            for n, left, made in states:
                if ends[n] == 2:
                    out.add((n, 0, made))  # the rest of the word is free
                    continue
                if c in children[n]:
                    out.add((children[n][c], left, made))
                if left:
                    out.add((n, left - 1, made + 1))
                    out.update((child, left - 1, made + 1) for child in children[n].values())
            return close(out)

        start = close({(n, e, 0) for e, n in roots.items()})
        known, todo, rows = {frozenset(): 0, start: 1}, [start], [[0] * (len(alphabet) + 1)]
        if not terms:  # from the start to nowhere
            self.table, self.accept = np.zeros((2, 1), dtype=np.int32), np.zeros(2, dtype=np.uint8)
            return
        while todo:
            states = todo.pop(0)
            row = []
            for c in ["\0", *alphabet]:
                after = step(states, c)
                if after not in known:
                    known[after] = len(known)
                    todo.append(after)
                    if len(known) > MAX_STATES:
                        raise ValueError("the lexicon is too large for one automaton")
                row.append(known[after])
            rows.append(row)
        self.table = np.array(rows, dtype=np.int32)
        self.accept = np.zeros(len(known), dtype=np.uint8)
        for states, i in known.items():
            made = [m for n, _, m in states if ends[n]]
            if made:
                self.accept[i] = 1 if min(made) == 0 else 2

    def match(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """``accept`` of each word; all words move on by one character per step."""
        top = max(map(ord, self.classes), default=0) + 1
        classes = np.zeros(top + 1, dtype=np.int32)
        for c, i in self.classes.items():
            classes[ord(c)] = i
        symbol = classes[np.minimum(points, top)]
        out = np.zeros(len(begin), dtype=np.uint8)
        word = np.arange(len(begin))
        at, state = begin.copy(), np.ones(len(begin), dtype=np.int32)
        while len(word):
            done = at == end[word]
            out[word[done]] = self.accept[state[done]]
            word, at, state = word[~done], at[~done], state[~done]
            state = self.table[state, symbol[at]]
            alive = state > 0
            word, at, state = word[alive], at[alive] + 1, state[alive]
        return out


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of each code point (where it is one), and which are in words."""
    lower = np.arange(0x110001, dtype=np.uint32)
    inside = np.zeros(0x110001, dtype=bool)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalnum():
            inside[c] = True
            if len(small := ch.lower()) == 1:
                lower[c] = ord(small)
    return lower, inside


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def features(raw: np.ndarray, offsets: np.ndarray, lexicon: Automaton, reporting: Automaton) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    if not _TABLES:
        _TABLES.append(_tables())
    lower, inside = _TABLES[0]
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return out
    heads = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    edges = heads[offsets]
    edge = np.zeros(len(points) + 1, dtype=bool)
    edge[edges] = True
    part = inside[points]
    begin = np.flatnonzero(part & (~np.append(False, part[:-1]) | edge[:-1]))
    end = np.flatnonzero(part & (~np.append(part[1:], False) | edge[1:])) + 1
    text = np.searchsorted(edges, begin, "right") - 1
    folded = lower[points]
    kind = lexicon.match(folded, begin, end)
    hit = np.flatnonzero(kind)
    words = np.bincount(text, minlength=n)
    if not len(hit):
        return out
    # quotation: an odd number of straight marks, or more opened than closed, since the line began
    new_line = (points == 10) | edge[:-1]
    line = np.maximum.accumulate(np.where(new_line, np.arange(len(points)), 0))
    def before(marks: np.ndarray) -> np.ndarray:
        return np.cumsum(marks) - marks

    straight = before(points == 0x22)
    opened = before(np.isin(points, (0xAB, 0x201C, 0x201E)).astype(np.int64) - np.isin(points, (0xBB, 0x201D)))
    at = begin[hit]
    quoted = ((straight[at] - straight[line[at]]) % 2 == 1) | (opened[at] > opened[line[at]])
    speech = np.flatnonzero(reporting.match(folded, begin, end))
    near = np.searchsorted(speech, hit, "left") - np.searchsorted(speech, hit - CONTEXT, "left") > 0
    if len(speech):
        last = speech[np.maximum(np.searchsorted(speech, hit, "left") - 1, 0)]
        near &= text[last] == text[hit]
    quoted |= near
    exact = kind[hit] == 1
    per_text = [np.bincount(text[hit[pick]], minlength=n) for pick in (~quoted & exact, ~quoted & ~exact, quoted)]
    for i, count in enumerate(per_text):
        out[:, 2 * i] = np.log1p(count)
        out[:, 2 * i + 1] = np.sqrt(100 * count / np.maximum(words, 1))
    # the window that begins at a match and holds most of them
    said = hit[~quoted & exact]
    if len(said):
        key = said + text[said] * WINDOW  # windows end with their text
        dense = np.searchsorted(key, key + WINDOW, "left") - np.arange(len(key))
        np.maximum.at(out[:, 6], text[said], np.log1p(dense))
    return out


@dataclass
class Model:
    terms: list[Term]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _absent(n1: int, d1, n0: int, d0):
    """The part of a log-likelihood ratio that texts without the term add."""
    without, rows = n1 + n0 - d1 - d0, n1 + n0

    def part(missing, total):
        return F.when(missing > 0, missing * F.log(missing * rows / (total * without))).otherwise(0.0)

    return part(n1 - d1, n1) + part(n0 - d0, n0)


def misspelled(word: str, seed: int) -> str:
    """The word with one letter inside it changed, dropped or doubled."""
    at = 1 + seed % (len(word) - 2)
    kind = seed // 7 % 3
    if kind == 0:
        return word[:at] + chr(0x61 + (ord(word[at]) - 0x61 + 1 + seed % 25) % 26) + word[at + 1 :]
    return word[:at] + word[at + 1 :] if kind == 1 else word[:at] + 2 * word[at] + word[at + 1 :]


def variants(text: str, label: int, terms: list[Term]) -> Iterator[tuple[str, int]]:
    """Training texts made of one: a toxic text with its terms misspelled; a clean text
    that quotes a term, in marks or after a word that reports speech."""
    words = [t.text for t in terms if t.edits]
    if not words:
        return
    seed = zlib.crc32(text.encode("utf-8", "replace"))
    if label:
        changed, n = re.subn(
            r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)",
            lambda m: misspelled(m[0].lower(), seed + m.start()), text, flags=re.IGNORECASE,
        )
        if n:
            yield changed, 1
    elif seed % 4 == 0:
        term = words[seed // 4 % len(words)]
        said = REPORTING[seed // 8 % len(REPORTING)]
        yield text + (f'\n"{term}"' if seed // 16 % 2 else f"\n{said} {term}"), 0


def _with_variants(sample: DataFrame, terms: list[Term]) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                rows += [(text, label), *variants(text, label, terms)]
            texts, labels = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(texts, pa.string()), pa.array(labels, pa.int32())], names=["text", "label"])

    return sample.select("text", "label").mapInArrow(make, "text string, label int")


def learn_terms(
    sample: DataFrame, *, max_terms: int = 200, min_docs: int = 4, odds: float = 20.0, alpha: float = 1.0,
    beginnings: tuple[int, ...] = (4, 5, 6),
) -> list[Term]:
    """Words, and word beginnings, that are ``odds`` times likelier in texts labelled 1.
    ``sample``: (text, label), bounded by the caller. At most ``max_terms`` are
    returned, by the number of texts labelled 1 that have them, times the share of different
    places (the words before and after) among their occurrences, so that near copies
    count as one text. A term must be more than chance: its log-likelihood ratio passes the bound of
    ``alpha`` shared by all terms tested (about so many pass by chance). Terms of five
    letters and more may be misspelled by one edit if they are words."""
    spoken = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    words = F.array_distinct(spoken)

    def heads(n: int):
        long_enough = F.filter(words, lambda w: F.length(w) >= n)
        return F.array_distinct(F.transform(long_enough, lambda w: F.substring(w, 1, n)))

    def sized(terms, n: int):
        return F.transform(terms, lambda w: F.struct(w.alias("term"), F.lit(n).alias("size")))

    kinds = [sized(words, 0), *[sized(heads(n), n) for n in beginnings]]
    exploded = sample.select("label", F.explode(F.flatten(F.array(*kinds))).alias("x"))
    n1, rows = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    n0 = rows - n1
    if not n1 or not n0:
        return []
    ratio = (F.col("d1") / n1) / ((F.col("d0") + 0.5) / n0)
    place = F.transform("w", lambda w, i: F.struct(w.alias("term"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("at")))
    placed = sample.where("label = 1").select(spoken.alias("w")).select(F.explode(place).alias("p")).select("p.term", "p.at")
    cuts = [F.struct(F.when(F.length("term") >= n, F.substring("term", 1, n)).alias("term"), F.lit(n).alias("size")) for n in beginnings]
    whole = F.struct(F.col("term"), F.lit(0).alias("size"))
    places = placed.select("at", F.inline(F.array(whole, *cuts))).groupBy("term", "size").agg(
        (F.count_distinct("at") / F.count("*")).alias("different")
    )
    texts = (
        exploded.where(F.length("x.term") >= 3).groupBy("x.term", "x.size")
        .agg(F.sum("label").alias("d1"), F.sum(1 - F.col("label")).alias("d0"))
        .where(F.col("d1") + F.col("d0") >= min_docs)
    )
    counted = written(
        sample.sparkSession,
        texts.join(places, ["term", "size"], "left")
        .select("term", "size", F.floor(F.col("d1") * F.coalesce("different", F.lit(0.0)) + 1e-9).alias("d1"), "d0"),
        "term-counts",
    )
    tested = counted.count()

    def part(seen, total):
        return F.when(seen > 0, seen * F.log(seen * rows / (total * (F.col("d1") + F.col("d0"))))).otherwise(0.0)

    # twice the log-likelihood ratio of the two groups' rates; its tail is about exp(-x / 2)
    surprise = 2 * (
        part(F.col("d1"), n1) + part(F.col("d0"), n0) + _absent(n1, F.col("d1"), n0, F.col("d0"))
    )
    found = (
        counted.where((F.col("d1") >= min_docs) & (ratio >= odds) & (surprise >= 2 * math.log(max(tested, 1) / alpha)))
        .orderBy(F.desc("d1"), "size", "term").limit(8 * max_terms).collect()
    )
    best = {(r.term, r["size"]): r.d1 for r in found}
    terms: list[Term] = []
    taken: set[str] = set()
    for r in sorted(found, key=lambda r: (-r.d1, r["size"] == 0, len(r.term), r.term)):
        term, size = r.term, r["size"]
        if any(term.startswith(t) for t in taken):
            continue
        if size and best.get((term, 0), 0) >= 0.9 * r.d1:
            continue  # the word itself is meant
        if size:
            # a beginning of one frequent word only is left to that word
            whole = max((d for (t, s), d in best.items() if s == 0 and t.startswith(term)), default=0)
            if whole >= 0.9 * r.d1:
                continue
            taken.add(term)
        terms.append(Term(term, bool(size), 0 if size or len(term) < 5 else 1))
        if len(terms) == max_terms:
            break
    terms = [t for t in terms if t.prefix or not any(t.text.startswith(p) for p in taken)]
    return _spared(terms, counted, best, n1, n0, odds)


def one_edit(a: str, b: str) -> bool:
    """Whether one letter inserted, dropped or changed makes ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


def _spared(terms: list[Term], counted: DataFrame, best: dict, n1: int, n0: int, odds: float) -> list[Term]:
    """The terms, without their edit where the words one edit away are ordinary: ``odds`` times
    rarer in texts labelled 0 than the term is in those labelled 1 is what they must be."""
    loose = [t for t in terms if t.edits]
    if not loose:
        return terms
    sent = counted.sparkSession.sparkContext.broadcast(Automaton(loose))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("term").to_pylist()
            end = np.cumsum([len(w) for w in words], dtype=np.int64)
            points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
            begin = np.append(0, end[:-1]) if len(words) else end
            yield batch.filter(pa.array(sent.value.match(points, begin, end) == 2))

    words = counted.where((F.col("size") == 0) & (F.col("d0") > 0)).select("term", "d0")
    around = words.mapInArrow(near, "term string, d0 bigint").toPandas()  # of the sample's words
    out = []
    for t in terms:
        clean = sum(d for w, d in zip(around["term"], around["d0"], strict=True) if one_edit(t.text, w)) if t.edits else 0
        rare = clean / n0 <= best.get((t.text, 0), 0) / n1 / odds
        out.append(t if rare else Term(t.text, t.prefix, 0))
    return out


def _rows(docs: DataFrame, automata) -> DataFrame:
    """``(row, f0, f1, ...)`` by Arrow batches; ``docs``: any columns and ``text``."""
    names = [f"f{i}" for i in range(len(FEATURES))]
    keep = [c for c in docs.columns if c != "text"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, reporting = automata.value
        for batch in text_chunks(batches, CHUNK_BYTES):
            offsets, raw = buffers(batch.column("text"))
            rows = features(raw, offsets, lexicon, reporting)
            yield pa.record_batch(
                [*[batch.column(c) for c in keep], *[pa.array(rows[:, i]) for i in range(rows.shape[1])]],
                names=[*keep, *names],
            )

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(make, ", ".join([kept, *[f"{n} double" for n in names]]))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression on standardised columns, by Newton steps. A weight of the wrong
    sign is held at zero, the others are fitted again."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    free = np.ones(z.shape[1], dtype=bool)
    while True:
        w = np.zeros(z.shape[1])
        part = z[:, free]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(part @ w[free], -30, 30)))
            gradient = part.T @ (p - y) + penalty[free] * w[free]
            hessian = (part.T * (p * (1 - p))) @ part + np.diag(penalty[free] + 1e-9)
            move = np.linalg.solve(hessian, gradient)
            w[free] -= move
            if np.abs(move).max() < 1e-8:
                break
        wrong = free & np.append(w[:-1] * np.array(SIGNS) < 0, False)
        if not wrong.any():
            return mean, scale, w
        free &= ~wrong


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, max_rows: int = 8000, max_terms: int = 200,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Learn lexicon and weights from at most ``max_rows`` labelled documents, those with
    the smallest hash of their id. Equal texts are taken once, so that a large group
    of copies doesn't rule the counts. Rows without an id, a
    label or a text are left out; conflicting labels of an id count as its
    largest. Without both labels the score is the share of label 1 (0.5 of none).
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label_col)).cast("int").alias("label")
    )
    chosen = known.orderBy(F.xxhash64(F.col("id"), F.lit(5)), "id").limit(max_rows)
    texts = narrow(docs, id_col, text_col)
    sample = (
        texts.join(F.broadcast(chosen), texts.doc_id == chosen.id)  # max_rows bounds it
        .withColumn("copy", F.sha2("text", 256))
        .groupBy("copy").agg(F.min_by(F.struct("text", "label"), "doc_id").alias("x"))
        .select("x.text", "x.label")
    ).where(F.length("text") > 0)
    sample = written(spark, sample, "toxicity-sample")
    terms = learn_terms(sample, max_terms=max_terms)
    automata = spark.sparkContext.broadcast(_automata(terms))
    rows = _rows(_with_variants(sample, terms), automata).toPandas()  # at most twice max_rows
    y = rows["label"].to_numpy(dtype=float)
    x = rows[[f"f{i}" for i in range(len(FEATURES))]].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        weights = np.zeros(len(FEATURES) + 1)
        weights[-1] = math.log(share / (1 - share))
        return Model(terms, np.zeros(len(FEATURES)), np.ones(len(FEATURES)), weights)
    return Model(terms, *_fit(x, y))


def _automata(terms: list[Term]) -> tuple[Automaton, Automaton]:
    return Automaton(terms), Automaton([Term(w, False, 0) for w in REPORTING])


def _scored(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score`` in place of ``text``."""
    automata = spark.sparkContext.broadcast(_automata(model.terms))
    z = F.lit(float(model.weights[-1]))
    for i in range(len(FEATURES)):
        z = z + (F.col(f"f{i}") - float(model.mean[i])) / float(model.scale[i]) * float(model.weights[i])
    z = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    kept = [c for c in rows.columns if c != "text"]
    return _rows(rows, automata).select(*kept, (1 / (1 + F.exp(-z))).alias("score"))


def score(
    spark: SparkSession, docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, score)``, one row per row of ``docs``: 0 to 1, higher is likelier toxic.
    Null and empty texts have no matches and score as such."""
    rows = narrow(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _scored(spark, rows, model)


def drop_toxic(
    spark: SparkSession, docs: DataFrame, model: Model, *, threshold: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all columns are kept. Of rows
    that share an id, or have none, only those whose own text is toxic go."""
    whole = packed(docs, id_col, text_col)
    marked = whole.select("id", "copy", F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"))
    gone = _scored(spark, marked, model).where(F.col("score") >= threshold)
    gone = gone.select(F.col("id").alias("gone_id"), F.col("copy").alias("gone_copy")).distinct()
    own = same(whole.id, gone.gone_id) & (whole.copy == gone.gone_copy)
    return whole.join(gone, own, "left_anti").select("row.*")
