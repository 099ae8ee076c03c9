"""Features by looking at each word, and a model whose score comes through them."""

import math
import random

import numpy as np
import pytest

from dossierflow.llm import toxicity
from dossierflow.llm.toxicity import FEATURES, REPORTING, SIGNS, Automaton, Term

TERMS = [Term("grim", False, 0), Term("vileword", False, 1), Term("nasti", True, 0), Term("ärgerlich", False, 1)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(text):
    """The features, word by word."""
    low = "".join(c.lower() if c.isalnum() and len(c.lower()) == 1 else c for c in text)
    words, at = [], None
    for i, c in enumerate(low + " "):
        if c.isalnum():
            at = i if at is None else at
        elif at is not None:
            words.append((at, low[at:i]))
            at = None
    counts, said_at = [0, 0, 0], []
    for n, (at, w) in enumerate(words):
        kinds = [0 if w == t.text or (t.prefix and w.startswith(t.text)) else distance(w, t.text) for t in TERMS
                 if (t.prefix and w.startswith(t.text)) or (not t.prefix and distance(w, t.text) <= t.edits)]
        if not kinds:
            continue
        line = low[low.rfind("\n", 0, at) + 1 : at]
        quoted = line.count('"') % 2 == 1 or sum(line.count(c) for c in "«“„") > sum(line.count(c) for c in "»”")
        quoted |= any(v in REPORTING for _, v in words[max(0, n - toxicity.CONTEXT) : n])
        exact = min(kinds) == 0
        counts[2 if quoted else 0 if exact else 1] += 1
        if exact and not quoted:
            said_at.append(n)
    row = []
    for c in counts:
        row += [math.log1p(c), math.sqrt(100 * c / max(len(words), 1))]
    dense = max((sum(a <= b < a + toxicity.WINDOW for b in said_at) for a in said_at), default=0)
    return [*row, math.log1p(dense)]


def test_features_equal_a_plain_reading():
    rng = random.Random(9)
    parts = [
        "grim", "GRIM", "vileword", "vilewrd", "vilewwword", "vilewords", "nastiest", "nast", "ärgerlich", "ÄRGERLCH", "said", "sagte",
        '"', "“", "”", "«", "»", "\n", ".", "x", "a1", "word", "und", "ok", "", "İ", "grimm",
    ]
    texts = ["", '"grim" said vileword', '"grim', "grim " * 30]
    texts += ["".join(rng.choice(parts) + rng.choice([" ", " ", " ", "", "\n"]) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    raws = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
    got = toxicity.features(
        np.frombuffer(b"".join(raws), dtype=np.uint8), offsets, Automaton(TERMS), Automaton([Term(w, False, 0) for w in REPORTING])
    )
    assert np.allclose(got, [plain(t) for t in texts])
    assert (got > 0).any(axis=0).all()


def test_one_edit():
    words = ["loser", "losers", "lose", "lover", "oser", "closer", "looser", "loserr", "lsoer", "lo", ""]
    assert [toxicity.one_edit("loser", w) for w in words] == [distance("loser", w) == 1 for w in words]
    for seed in range(200):
        assert distance("worthless", toxicity.misspelled("worthless", seed)) == 1


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(4)
    calm = "the of harbour report people water morning garden window table seven city road light paper".split()
    rows = []
    for i in range(500):
        words = rng.choices(calm, k=rng.randint(20, 60))
        label = int(i % 6 == 0)
        if label:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "grimterm", "badname"]))
        rows.append((i, " ".join(words), label))
    # near copies of one toxic text: its other words are not terms
    copied = " ".join(rng.choices([f"rare{i}" for i in range(8)], k=12)) + " vileword badname vileword"
    rows += [(600 + i, copied + f" tail{i}", 1) for i in range(12)]
    # an ordinary word one edit from a term
    rows += [(700 + i, " ".join(rng.choices(calm, k=20)) + " badnames", 0) for i in range(20)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    return toxicity.fit(spark, docs, labels)


def test_terms_are_those_of_many_places(learned):
    assert {t.text: t.edits for t in learned.terms if not t.prefix} == {"vileword": 1, "grimterm": 1, "badname": 0}
    assert not any(t.text.startswith("rare") for t in learned.terms)


def test_weights_have_their_signs_and_take_part(learned):
    weights = dict(zip(FEATURES, learned.weights, strict=False))
    assert all(w * s >= 0 for w, s in zip(learned.weights, SIGNS, strict=False))
    assert weights["said"] + weights["said_rate"] > 0.1
    assert weights["fuzzy"] + weights["fuzzy_rate"] > 0.1
    assert weights["quoted"] + weights["quoted_rate"] < -0.1


def test_misspelling_raises_and_quotation_lowers_the_score(spark, learned):
    base = "people report the seven lights of the harbour city in the morning paper"
    probes = [
        base, base + " vileword grimterm", base + " vilewrd grinterm", base + '\n"vileword grimterm"', base + " he said vileword grimterm",
        base + " badnames badnames", None, "",
    ]
    df = spark.createDataFrame(list(enumerate(probes)), "doc_id bigint, text string")
    clean, said, fuzzy, marks, speech, ordinary, null, empty = [r.score for r in toxicity.score(spark, df, learned).orderBy("doc_id").collect()]
    assert said > 0.9 and fuzzy > 0.5 > clean
    assert max(marks, speech) <= clean and ordinary == pytest.approx(clean)
    assert null == empty == pytest.approx(clean)


def test_a_very_long_text(spark, learned):
    text = "morning paper " * 300_000
    df = spark.createDataFrame([(1, text), (2, text + "vileword " * 200_000)], "doc_id bigint, text string")
    low, high = [r.score for r in toxicity.score(spark, df, learned).orderBy("doc_id").collect()]
    assert low < 0.5 < high
