"""Preference formatting and toxicity."""

import zlib
from collections import Counter, defaultdict

import fixtures as fx
import pandas as pd
import pytest

from ledgerlens.llm import preferences, toxicity
from ledgerlens.llm.common import prepare
from ledgerlens.llm.linear import ngrams, letters

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


# ------------------------------------------------------------------ op8

def render(role, text):
    clean = lambda s: (s or "").replace("<|im_start|>", "<| im_start|>").replace("<|im_end|>", "<| im_end|>")
    head = f"<|im_start|>{clean(role)}\n"
    return head, head + clean(text) + "<|im_end|>"


def formatted(chosen, rejected):
    out = []
    for pair in {r[0] for r in chosen + rejected if r[0] is not None}:
        side = [defaultdict(list), defaultdict(list)]
        for k, rows in enumerate((chosen, rejected)):
            for p, turn, role, text in rows:
                if p == pair and turn is not None:
                    side[k][turn].append((role or "", text or ""))
        first = next((t for t in sorted({*side[0], *side[1]}) if sorted(side[0][t]) != sorted(side[1][t])), None)
        for k, name in enumerate(("chosen", "rejected")):
            for turn, said in side[k].items():
                prompt = first is None or turn < first
                if prompt and k:
                    continue
                for role, text in said:
                    head, whole = render(role, text)
                    on = not prompt and role == "assistant"
                    out.append((pair, "prompt" if prompt else name, turn, role, whole + "\n",
                                len(head) if on else 0, len(whole) if on else 0))
    return sorted(out)


CHOSEN = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so"), (1, 3, "assistant", "good"),
          (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, None, None), (3, 1, "assistant", "<|im_end|>x"),
          (4, 0, "user", "q"), (4, 0, "user", "q"), (4, 1, "assistant", "é"), (None, 0, "user", "z"), (5, None, "user", "z"),
          (5, 0, "user", "only chosen")]
REJECTED = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so"), (1, 3, "assistant", "bad"),
            (1, 4, "user", "why"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "", ""), (3, 1, "assistant", "y"),
            (4, 0, "user", "q"), (4, 1, "assistant", "é")]


def test_preference_pairs_match_brute_force(spark):
    got = preferences.preference_pairs(spark.createDataFrame(CHOSEN, TURNS), spark.createDataFrame(REJECTED, TURNS))
    assert sorted(map(tuple, got.collect())) == formatted(CHOSEN, REJECTED)


def test_masks_cover_the_answer_and_the_end_mark(spark):
    got = preferences.preference_pairs(spark.createDataFrame(CHOSEN, TURNS), spark.createDataFrame(REJECTED, TURNS))
    row = got.filter("pair_id = 1 and part = 'rejected' and role = 'assistant'").first()
    assert row.rendered[row.train_from:row.train_to] == "bad<|im_end|>"


def test_preferences_of_an_empty_table(spark):
    chosen, rejected = preferences.swapped_answers(spark.createDataFrame([], TURNS))
    assert preferences.preference_pairs(chosen, rejected).count() == 0


# ------------------------------------------------------------------ op9

@pytest.fixture(scope="module")
def small(spark):
    """Clean and insulting texts; labels of two thirds."""
    import random
    rng, rows, labels = random.Random(6), [], []
    for i in range(400):
        text = fx.words(rng, 40)
        bad = i % 4 == 0
        if bad:
            parts = text.split(" ")
            for _ in range(4):
                parts[rng.randrange(40)] = rng.choice(["idiot", "moron", "worthless"])
            text = " ".join(parts)
        rows.append((i, text, None, None))
        if i % 3:
            labels.append((i, int(bad)))
    labels += [(5, 0), (None, 1), (9999, 1), (2, None)]
    return fx.frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_separates_held_out_rows(small):
    docs, labels = small
    rows = toxicity.toxicity(fx.clashing(docs), labels).collect()
    assert len(rows) == 400 and {r.held_out for r in rows} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    wrong = [r for r in held if r.predicted != (r.doc_id % 4 == 0)]
    assert len(wrong) <= 0.05 * len(held)


def test_disguised_words_are_restored_and_scored(small):
    docs, labels = small
    language, places, weights, bias = toxicity.train_model(docs, labels)
    restorer = toxicity.Restorer(language)
    for word, plain in (("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooot", "idiot"), ("i d i o t", "idiot"),
                        ("w.o.r.t.h.l.e.s.s", "worthless"), ("(M0R0N)!", "(moron)!"), ("*m*ron*", "*moron*")):
        assert restorer.restore(word) == plain
    clean = "stone river 42 under a@b.org +1 (555) 010 '9999'"
    assert toxicity.SUSPECT.search(restorer.restore(clean)) is None or "stone river 42" in restorer.restore(clean)


# every form of a disguise, for words of the training texts
FORMS = {
    "a sign at the end": ("worthle55", "worthless"), "signs at the end": ("worthle$$", "worthless"),
    "a sign at the end of a sentence": ("worthle$$!", "worthless!"), "one sign at the end": ("idio7", "idiot"),
    "one mark at the end": ("idio+", "idiot"), "one sign at the start": ("1diot", "idiot"), "a bar at the start": ("|diot", "idiot"),
    "every letter doubled": ("iiddiioott", "idiot"), "doubled signs": ("mm00rr00nn", "moron"),
    "spaced with signs": ("1 d 1 0 t", "idiot"), "spaced with a sign": ("m o r 0 n", "moron"),
    "dotted with signs": ("i.d.1.o.t", "idiot"), "dashed with signs": ("m-0-r-0-n", "moron"),
    "spaced, a sign near the end": ("w o r t h l e 5 s", "worthless"), "wide gaps": ("i  d  i  o  t", "idiot"),
    "wider gaps with signs": ("m   0  r   0  n", "moron"), "spaced marks": ("i - d - i - o - t", "idiot"),
}


@pytest.mark.parametrize("form", FORMS)
def test_every_form_of_a_disguise_is_read(small, form):
    word, plain = FORMS[form]
    assert toxicity.Restorer(_model(small)[0]).restore(word) == plain


def test_planted_words_of_every_form_are_found_in_held_out_rows(spark, small):
    """Whole texts that no training row holds: all three words disguised, as
    plain words, and clean."""
    import random
    rng, rows = random.Random(16), []
    for k, (word, plain) in enumerate(FORMS.values()):
        clean = fx.words(rng, 40).split(" ")
        hidden = {"idiot": "1 d 1 0 t", "moron": "m o r 0 n", "worthless": "worthle55"} | {plain.strip("!"): word}
        for j, words in enumerate((hidden.values(), hidden, ())):
            parts = clean.copy()
            for at, x in zip((3, 14, 27), words):
                parts[at] = x
            rows.append((j * 1000 + k, " ".join(parts), None, None))
    docs = fx.frame(spark, rows)
    score = {r.doc_id: r.score for r in docs.select("doc_id", toxicity.scores(docs, _model(small)).alias("score")).collect()}
    for k, form in enumerate(FORMS):
        assert score[2000 + k] < 0.7 <= score[k], form
        assert abs(score[k] - score[1000 + k]) < 0.05, form


def test_common_text_is_left_alone(small):
    restorer = toxicity.Restorer(_model(small)[0])
    for text in ("stone river!", "under 42 - 17", "1 2 3 4 5", "stone, light.", "+1 (555) 010", "1.2.3.4", "seven-window"):
        assert restorer.restore(text) == text


_models: dict = {}


def _model(small):
    if "model" not in _models:
        _models["model"] = toxicity.train_model(*small)
    return _models["model"]


def test_viterbi_takes_the_best_path(small):
    """Against trying every path of the lattice."""
    import itertools
    docs, labels = small
    language = toxicity.train_model(docs, labels)[0]
    restorer = toxicity.Restorer(language)

    def score(parts):
        s, a, b = sum(p[1] for p in parts), "^", "^"
        for c in "".join(p[0] for p in parts) + "$":
            s += language.log(a, b, c)
            a, b = b, c
        return s
    for word in ("1d1*t", "mo0r0nn", "st0n3", "l1|gh7"):
        best = max(itertools.product(*restorer.lattice(word)), key=score)
        assert abs(score(best) - max(score(p) for p in itertools.product(*restorer.lattice(word))
                                     if "".join(x[0] for x in p) == restorer.viterbi(word))) < 1e-9


def test_toxicity_edge_cases(spark, small):
    docs, labels = small
    edge = fx.frame(spark, fx.documents())
    rows = toxicity.toxicity(edge, labels).collect()
    assert len(rows) == len(fx.documents()) and all(0 <= r.score <= 1 for r in rows)
    none = labels.filter("toxic = 0")
    assert {r.score for r in toxicity.toxicity(edge, none).collect()} == {0.0}
    assert toxicity.drop_toxic(edge, none).count() == len(fx.documents())
    empty = spark.createDataFrame([], fx.SCHEMA)
    assert toxicity.toxicity(empty, labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    clean = docs.filter("doc_id % 4 <> 0").count()
    assert kept.filter("doc_id % 4 <> 0").count() >= 0.97 * clean and kept.count() <= 1.05 * clean


def test_ngrams_never_cross_words():
    assert set(ngrams(letters("ab cd"), (2,), 18)) == set(ngrams(letters("cd, ab!"), (2,), 18))
    assert len(ngrams(letters("12 !?"), (1, 2, 3), 18)) == 0


def test_every_training_row_is_counted_and_dealt(spark, small):
    """More rows than a shard takes: none is left out of the language model or
    of the classifier; a row given twice weighs twice."""
    from collections import Counter
    docs, labels = small
    twice = docs.unionByName(docs.filter("doc_id = 4"))
    rows = toxicity.training_rows(twice, labels)
    mine = {r.doc_id for r in labels.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in mine}
    held_back = {5} if 5 not in texts else set()
    assert {r._id for r in rows.collect()} == set(texts) - held_back
    words = Counter()
    for i in [*texts, *([4] if 4 in texts else [])]:
        words.update(w for w in toxicity._RUN.findall(texts[i].lower()) if len(w) > 1)
    language = toxicity.train_model(twice, labels, per_class=20)[0]
    assert language.three == toxicity.trigrams(words)
    n = toxicity.counts(rows)
    dealt, shards = toxicity.deal(rows, n, 20)
    got = dealt.collect()
    assert shards > 3 and {r._id for r in got} == set(texts)
    assert {r._n for r in got if r._id == 4} <= {2} and {r._n for r in got if r._id != 4} == {1}
    clean = [r for r in got if r._label == 0]
    assert len(clean) == len({r._id for r in clean})
    for k in range(shards):
        assert {r._label for r in got if r._shard == k} == {0, 1}
        assert sum(r._shard == k for r in got) <= 120


def test_the_mean_of_many_shards_finds_what_one_finds(spark, small):
    docs, labels = small
    held = toxicity.toxicity(docs, labels, per_class=100).filter("held_out").collect()
    assert sum(r.predicted != (r.doc_id % 4 == 0) for r in held) <= 0.05 * len(held)


def test_two_mirrored_columns_are_one():
    import numpy as np
    from ledgerlens.llm.linear import BinaryFtrl, Ftrl
    rng = np.random.default_rng(3)
    both, one = Ftrl(2, 50, l1=0.4), BinaryFtrl(50, l1=0.4)
    for _ in range(300):
        idx, y = np.unique(rng.integers(0, 50, 8)), int(rng.integers(0, 2))
        both.update(idx, np.ones(len(idx)), y)
        one.update(idx, y)
    w = both.weights()
    assert np.allclose(w[:, 1] - w[:, 0], one.weights(), atol=1e-9)


def test_only_words_that_look_disguised_are_looked_at():
    """Of a text without such a word, none; of others, each word that holds a
    match of ``SUSPECT``, wherever white space and marks lie."""
    import random
    restorer = toxicity.Restorer(toxicity.Language(toxicity.trigrams(Counter({"stone": 3, "river": 2}))))
    text = " ".join(f"stone{c} river" for c in "abcdfghijk")
    assert restorer.restore(text) == text and not restorer
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("aabcé²ΣI 01$*!.-_\t\n ", k=rng.randint(0, 30))).lower()
        cps, kinds = toxicity._kinds_of(text)
        want = [i for i, word in enumerate(text.split()) if restorer._suspect(word)]
        assert toxicity._suspects(cps, kinds) == want, text
        assert toxicity._may_be_spaced(kinds) or toxicity.SPACED.search(text) is None, text


def test_letters_alone_are_read_as_through_their_lattice():
    import random
    rng = random.Random(4)
    language = toxicity.Language(toxicity.trigrams(Counter(
        "".join(rng.choices("abcd", k=rng.randint(2, 6))) for _ in range(200))))
    restorer = toxicity.Restorer(language)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") * rng.choice((1, 1, 1, 2, 2, 3, 4)) for _ in range(rng.randint(1, 6)))
        best = {("^", "^"): (0.0, None)}
        for options in restorer.lattice(word):
            best = restorer._step(best, options)
        assert restorer.viterbi(word) == restorer._text(restorer._end(best)[1]), word


def test_packed_trigrams_are_those_of_the_words():
    for texts in ([], [""], ["a"], ["a b", "ab"], ["Stone x river", "ñandú😀ab²c", "stone\nriver ab1cd"]):
        words = Counter(w for t in texts for w in toxicity._WORD.findall(t.lower()))
        found, n = toxicity._packed_trigrams(texts)
        assert dict(zip(map(toxicity._unpacked, found.tolist()), n.tolist())) == toxicity.trigrams(words)
    cuts = toxicity._cuts(pd.Series(["x" * 300_000] * 5))
    assert cuts.tolist() == [1, 3, 4]


def test_words_never_seen_are_read_by_the_neighbours_of_their_runs():
    """Runs of letters and signs at a word's end are chosen once for all words
    that hold them between the same neighbours, as the whole lattice would."""
    import random

    language = toxicity.Language(toxicity.trigrams(Counter(
        {"letter": 9, "better": 4, "pal": 5, "apple": 3, "see": 6, "tell": 2, "least": 4, "passes": 3, "bets": 2})))
    restorer = toxicity.Restorer(language)
    draw = random.Random(5)
    words = []
    for _ in range(3_000):
        word = "".join(draw.choice("aeplst") * draw.choice((1, 1, 1, 2, 2, 3, 4)) for _ in range(draw.randint(2, 9)))
        words.append(word + draw.choice(("", "", ",", "$$$", "!", "!!", "1", "***")))

    def plain(word):
        """Through every place of the lattice, in whole words of letters."""
        return restorer._text(restorer._end(_all_places(restorer, word))[1])
    assert [restorer[w] for w in words if w.isalpha()] == [plain(w) for w in words if w.isalpha()]
    tailed = toxicity.Restorer(language)
    tailed._read_tailed = lambda body, tail: None                 # the whole lattice
    assert [restorer[w] for w in words] == [tailed[w] for w in words]

    class Counting(dict):
        looks = 0

        def get(self, *key):
            Counting.looks += 1
            return super().get(*key)
    language.held = Counting()
    fresh, half = toxicity.Restorer(language), len(words) // 2
    for word in words[:half]:
        fresh[word]
    first, Counting.looks = Counting.looks, 0
    fresh.clear()
    for word in words[half:]:
        fresh[word]
    assert first and Counting.looks < 8 * half, (first, Counting.looks)


def _all_places(restorer, word):
    best = {("^", "^"): (0.0, None)}
    for options in restorer.lattice(word):
        best = restorer._step(best, options)
    return best


def test_a_shard_uses_no_more_places_than_it_holds(monkeypatch):
    """The model of a shard has a slot for each of its own n-grams alone, and
    the weights come back under their places."""
    sizes = []

    class Sized(toxicity.BinaryFtrl):
        def __init__(self, size, **options):
            sizes.append(size)
            super().__init__(size, **options)
    monkeypatch.setattr(toxicity, "BinaryFtrl", Sized)
    texts = [f"good river {i}" if i % 2 else f"bad stone {i}" for i in range(200)]
    found = toxicity._fit(2)(pd.DataFrame(
        {"_mix": range(200), "_text": texts, "_label": [1 - i % 2 for i in range(200)], "_n": 1}))
    own = set(toxicity._places(" ".join(texts)).tolist())
    assert sizes and sizes[0] <= len(own) + 1
    weights = dict(zip(found["place"], found["weight"]))
    assert weights and set(weights) <= own | {1 << toxicity.BITS}
    bad, good = (sum(weights.get(p, 0.0) for p in toxicity._places(t).tolist()) for t in ("bad stone", "good river"))
    assert bad > 0 > good
