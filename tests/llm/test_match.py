import hashlib
import random
import re

from dossierflow.llm import chat, decontaminate, toxicity
from dossierflow.llm.toxicity import Automaton, Term

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text):
    return re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(texts, items, window):
    patterns = {}
    for item, text in items:
        w = _words(text)
        m = min(window, len(w))
        for k in range(len(w) - m + 1) if m else ():
            patterns.setdefault(tuple(w[k : k + m]), set()).add(item)
    out = []
    for text in texts:
        w, hit, found = _words(text), set(), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                if p := patterns.get(tuple(w[k : k + m])):
                    hit.update(range(k, k + m))
                    found |= p
        names = sorted(map(str, found))
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest()))
    return out


def test_contamination_equals_brute_force(spark, docs, by_id):
    rng = random.Random(9)
    words = [*"abcdefg", "É", "x1", "Ünder", "the"]

    def some(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choices(words, k=n))

    items = [(i, some(rng.randint(0, 14))) for i in range(14)] + [(3, some(12)), (20, None), (21, "Lone"), (22, "two words")]
    texts = [some(rng.randint(0, 700)) for _ in range(30)]
    texts += [f"{some(5)} {t} {some(5)}".upper() for _, t in items if t] + [None, "", "...", "lone", "Two  WORDS", items[0][1]]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, lang string")
    for window, block in ((4, 16_000_000), (4, 40), (10, 16_000_000)):
        got = by_id(decontaminate.find_contamination(spark, docs(texts), bench, window=window, block_bytes=block))
        for i, want in enumerate(_brute(texts, items, window)):
            assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256) == want, (i, window, block)


def test_contamination_edges(spark, docs):
    bench = spark.createDataFrame([(1, "a b c"), (None, "q")], "item_id bigint, text string")
    df = docs(["x a b c y", "x a b c y", "clean", "q"], [5, 5, None, 6])
    got = decontaminate.find_contamination(spark, df, bench, window=3)
    assert sorted((r.doc_id or -1, r.n_hit, tuple(r["items"])) for r in got.collect()) == [
        (-1, 0, ()), (5, 3, ("1",)), (5, 3, ("1",)), (6, 1, ("null",))
    ]
    stay = decontaminate.drop_contaminated(spark, df, bench, window=3)
    assert [r.text for r in stay.collect()] == ["clean"] and stay.columns == df.columns
    none = bench.where("false")
    assert decontaminate.find_contamination(spark, df, none).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(spark, df.where("false"), bench).count() == 0


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    import numpy as np

    rng = random.Random(12)
    terms = [Term("abcab", False, 1), Term("bacca", False, 1), Term("cab", False, 0), Term("abb", True, 0)]
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 8))) for _ in range(3000)]
    text = " ".join(words)
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    got = Automaton(terms).match(points, ends - [len(w) for w in words], ends)
    for w, g in zip(words, got.tolist(), strict=True):
        exact = w in ("abcab", "bacca", "cab") or w.startswith("abb")
        fuzzy = any(_distance(w, t.text) <= 1 for t in terms[:2])
        assert g == (1 if exact else 2 if fuzzy else 0), w


def test_toxicity_learns_misspellings_and_quotation(spark, docs, by_id):
    rng = random.Random(7)
    plain = ["".join(rng.choices("aeioustrn", k=6)) for _ in range(300)]
    texts, labels = [], []
    for i in range(400):
        words = rng.choices(plain, k=rng.randint(20, 60))
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["villain", "scoundrel", f"zork{rng.choice(plain)}"]))
        texts.append(" ".join(words))
        labels.append((i, int(i % 4 == 0)))
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(spark, docs(texts), known)
    found = {(t.text, t.prefix) for t in model.terms}
    assert {("villain", False), ("scoundrel", False), ("zork", True)} <= found
    clean = " ".join(plain[:30])
    probes = [
        f"{clean} villain scoundrel villain {clean}", clean, f'{clean} "villain scoundrel villain" {clean}', "", None,
        f"{clean} zorkxyz zorkabc zorkq {clean}",
    ]
    got = by_id(toxicity.score(spark, docs(probes), model))
    score = [got[i].score for i in range(6)]
    assert score[0] > 0.5 > score[1] and score[5] > 0.5
    assert score[2] < 0.5 and score[3] < 0.5 and score[3] == score[4]
    stay = toxicity.drop_toxic(spark, docs(probes), model)
    assert sorted(r.doc_id for r in stay.collect()) == [1, 2, 3, 4]
    # rows that share an id, or have none, are judged by their own text
    shared = docs([probes[0], clean, probes[0], None, clean], [7, 7, None, None, None])
    stay = toxicity.drop_toxic(spark, shared, model)
    assert sorted((r.doc_id or 0, r.text or "") for r in stay.collect()) == [(0, ""), (0, clean), (7, clean)]
    assert all(0 <= s <= 1 for s in score)
    assert toxicity.score(spark, docs(["a"]).where("false"), model).count() == 0


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(spark, docs(["a", None]), none)
    assert [r.score for r in toxicity.score(spark, docs(["a", None]), model).collect()] == [0.5, 0.5]


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_round_trip(spark):
    rng = random.Random(3)
    pieces = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "\n", "é", "~n", "~", "<\\|", "<\\\\|", "assistant", "😀", ""]
    rows = [
        (rng.choice([0, 1, 2, None]), t, rng.choice(["user", "assistant", "sy\nstem~", None]),
         rng.choice([None, "".join(rng.choices(pieces, k=rng.randint(0, 12)))]))
        for t in range(300)
    ]
    made = chat.format_conversations(_turns(spark, rows))
    key = {}
    for c, t, role, text in rows:
        key.setdefault(c, []).append((t, role or "", text or ""))
    got = {}
    for r in made.orderBy("conv_id", "piece").collect():
        got.setdefault(r.conv_id, []).extend(chat.parse(r.formatted))
        spans = [chat.unescape(r.formatted[s.first : s.last]) for s in r.loss]
        assert spans == [t for role, t in chat.parse(r.formatted) if role == "assistant"]
    assert got == {c: [(role, text) for _, role, text in sorted(v)] for c, v in key.items()}
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    for c, turns in key.items():
        all_text = "".join(f"{role}\n{text}\n" for _, role, text in sorted(turns))
        learned = "".join(text for _, role, text in sorted(turns) if role == "assistant")
        assert back[c].n_turns == len(turns)
        assert back[c].turns_sha256 == hashlib.sha256(all_text.encode()).hexdigest()
        assert (back[c].loss_chars, back[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_long_conversations_come_in_pieces(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"said {t}") for c in (1, 2, 3) for t in range(70)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        made = chat.format_conversations(_turns(spark, rows))
        assert made.groupBy("conv_id").count().where("count > 1").count() == 3
        assert made.where("last").count() == 3
        back = chat.read_back(made).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.conv_id, r.n_turns) for r in back) == [(1, 70), (2, 70), (3, 70)]
    assert len({(r.turns_sha256, r.loss_sha256) for r in back}) == 1


def test_chat_ties_and_nothing(spark):
    made = chat.format_conversations(_turns(spark, [(1, None, "user", "b"), (1, 1, "user", "z"), (1, 1, "user", "a")]))
    assert chat.parse(made.first().formatted) == [("user", "b"), ("user", "a"), ("user", "z")]
    assert chat.read_back(chat.format_conversations(_turns(spark, []))).count() == 0
