"""Operators over documents against brute force on a small table."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import fixtures as fx
import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from ledgerlens.llm import (
    byte_bpe, exact_dedup, fingerprints, language_id, ngram_join, pii, source_mixing, token_counts)
from ledgerlens.llm.common import prepare

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return fx.frame(spark, fx.documents()).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], fx.SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ------------------------------------------------------------------ op1

def normal(text):
    return "".join(c for c in text or "" if c not in SPACE)


def test_exact_dedup_matches_brute_force(docs):
    groups = defaultdict(list)
    for i, text, *_ in fx.documents():
        groups[hashlib.sha256(normal(text).encode()).hexdigest()].append((i, len(text or "")))
    got = defaultdict(list)
    for r in rows_of(exact_dedup.exact_dedup(docs)):
        got[r["text_sha256"]].append(r)
    assert set(got) == set(groups)
    for h, own in groups.items():
        best = min(own, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        assert sorted(str(r["doc_id"]) for r in got[h]) == sorted(str(i) for i, _ in own)
        assert {r["keep_id"] for r in got[h]} == {best[0]}
        assert {r["group_size"] for r in got[h]} == {len(own)}
        assert [r["doc_id"] for r in got[h] if r["kept"]] == [best[0]]


def test_rows_without_a_possible_copy_do_not_shuffle(docs):
    rows = rows_of(exact_dedup.exact_dedup(docs))
    assert all(r["candidate"] for r in rows if r["group_size"] > 1)
    assert sum(not r["candidate"] for r in rows) > 0.7 * sum(r["group_size"] == 1 for r in rows)


@pytest.mark.parametrize("bits", [4096, 1 << 30])
def test_filter_ranges_do_not_change_the_result(docs, bits):
    """A tiny bound cuts the hash space into ranges; all verdicts agree."""
    key = lambda r: (str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
    a = sorted(map(key, rows_of(exact_dedup.exact_dedup(docs, max_filter_bits=bits))), key=str)
    assert a == sorted(map(key, rows_of(exact_dedup.exact_dedup(docs))), key=str)


def test_drop_copies_keeps_one_whole_row_each(docs):
    kept = exact_dedup.drop_copies(fx.clashing(docs))
    assert kept.columns == fx.clashing(docs).columns
    texts = [normal(r["text"]) for r in rows_of(kept)]
    assert len(texts) == len(set(texts)) == len({normal(t) for _, t, *_ in fx.documents()})


@pytest.mark.parametrize("rows", [
    [(7, None, "en", "s0"), (8, "", "de", "s1"), (9, None, None, "s2"), (3, "stone", "en", "s0")],
    [(8, None, "de", "s1"), (8, None, "de", "s1"), (None, None, "en", "s3")],
    [(None, None, "en", "s0"), (None, "", "en", "s0")]])
def test_drop_copies_keeps_the_row_of_null_and_empty_texts(spark, rows):
    df = fx.frame(spark, rows)
    want = sorted(str(r["doc_id"]) for r in rows_of(exact_dedup.exact_dedup(df)) if r["kept"])
    kept = [tuple(r) for r in exact_dedup.drop_copies(df).collect()]
    assert sorted(str(r[0]) for r in kept) == want
    assert all(r in rows for r in kept)


def test_drop_copies_keeps_a_lone_null_text_that_the_filter_takes_for_a_copy(spark, monkeypatch):
    probe = exact_dedup._probe
    monkeypatch.setattr(exact_dedup, "_probe", lambda *a: probe(*a).selectExpr("* except (_maybe)", "true as _maybe"))
    df = fx.frame(spark, [(7, None, "en", "s0"), (3, "stone", "de", "s1")])
    assert sorted(map(tuple, exact_dedup.drop_copies(df).collect())) == [(3, "stone", "de", "s1"), (7, None, "en", "s0")]


def test_exact_dedup_of_an_empty_table(empty):
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


# ------------------------------------------------------------------ op2

def test_fingerprints_of_edited_and_next_text(docs):
    rows = [r for r in fx.documents() if r[0] is not None]
    by_id = {i: t or "" for i, t, *_ in rows}
    ids = sorted(by_id, reverse=True)
    after = dict(zip(ids, [*ids[1:], None]))
    got = {r["doc_id"]: r for r in rows_of(fingerprints.compare_with_next(
        docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), rows_per_range=16))}
    assert set(got) == set(by_id)
    prints = {}
    for i, text in by_id.items():
        j = after[i] if after[i] is not None else ids[0]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + by_id[j][:cut]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (edited == text)
        assert (r["near_edited"] == 1) >= (edited == text) and 0 <= r["near_next"] <= 1
        assert (r["edit_paragraph"] is None) == (edited == text)
        if edited != text:
            lines = list(zip(text.split("\n"), edited.split("\n")))
            differ = [k for k, (a, b) in enumerate(lines) if a != b]
            assert r["edit_paragraph"] == (differ[0] if differ else len(lines))
        assert prints.setdefault(r["fingerprint"], text) == text
    long = [r for r in got.values() if 500 < r["n_chars"] < 10_000]
    # neighbours may share the passage; the edited text shares two thirds
    assert sum(r["near_edited"] - r["near_next"] for r in long) > 0.3 * len(long)


def test_fingerprints_of_tiny_tables(spark, empty):
    assert fingerprints.compare_with_next(empty).count() == 0
    one = rows_of(fingerprints.compare_with_next(spark.createDataFrame([(5, "a b c", None, None)], fx.SCHEMA)))
    assert len(one) == 1 and one[0]["near_next"] == 1
    odd = spark.createDataFrame([(None, "x", None, None), (3, None, None, None), (3, "q\nw", None, None)], fx.SCHEMA)
    assert fingerprints.compare_with_next(fx.clashing(odd)).count() == 3
    same = rows_of(fingerprints.fingerprints(spark.createDataFrame([(1, "a\nb", None, None), (2, "a\nb", None, None)], fx.SCHEMA)))
    assert same[0]["fingerprint"] == same[1]["fingerprint"]


# ------------------------------------------------------------------ op3

def test_mixing_targets_and_copies(docs):
    rows = rows_of(source_mixing.mix_counts(docs))
    assert len(rows) == len(fx.documents())
    size = defaultdict(int)
    for _, text, _, source in fx.documents():
        size[source] += len([w for w in re.split(f"[{SPACE}]+", text or "") if w])
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(order)
    while open_:                                     # share, stop at the cap, share again
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 2 * size[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = 2 * size[s]
            open_.discard(s)
            left -= target[s]
    expected = sorted((size[s], round(target[s], 6)) for s in order)
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in rows}) == expected
    taken = defaultdict(int)
    for r in rows:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    largest = max(r["size"] for r in rows)
    for key, words in taken.items():
        assert abs(words - key[1]) <= largest / 2 + 1
    again = rows_of(source_mixing.mix_counts(docs))
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_repeats_rows_and_keeps_columns(docs, empty):
    wide = fx.clashing(docs)
    mixed = source_mixing.mix(wide)
    assert mixed.columns == wide.columns
    copies = Counter((r["doc_id"], r["text"]) for r in rows_of(mixed))
    counts = Counter()
    for r in rows_of(source_mixing.mix_counts(docs)):
        counts[r["doc_id"]] += r["copies"]
    by_id = Counter()
    for (i, _), n in copies.items():
        by_id[i] += n
    assert {i: n for i, n in counts.items() if n} == dict(by_id)
    assert source_mixing.mix_counts(empty).count() == 0 and source_mixing.mix(empty).count() == 0


# ------------------------------------------------------------------ op4

def test_token_counts_equal_the_library(docs, empty):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows_of(token_counts.token_counts(docs, PIECES))}
    want = {(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096)
            for i, t, *_ in fx.documents()}
    assert got == want
    assert token_counts.token_counts(empty, PIECES).count() == 0


def test_token_counter_on_odd_texts():
    counter = token_counts.counter(PIECES)
    rng = random.Random(4)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "▁", "é", "中", "😀", "<s>", "</s>", "<unk>", "\x00", "'", "9", " the"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)]
    assert [counter.count(t) for t in texts] == [len(x) for x in counter.library.encode(texts)]
    assert len(counter.whole) > 10_000


# ------------------------------------------------------------------ op5

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), k, m.end(), kind))
    return sorted(found)


def test_pii_base_spans_match_the_plain_patterns(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("a.B@1+2 -(3é😀%_") for _ in range(rng.randrange(60))) for _ in range(2500)]
    texts += [None, "", "1 " * 30_000, "9" * 30_000, "a" * 50_000 + "@" + "b.c" * 8_000, "+1" + "(" * 40_000, "1." * 20_000,
              "4111 1111 1111 1111, a@b.co; 10.0.0.255 and +1 (555) 010-9999", "256.1.1.1 0300.1.1.1 00255.1.1.1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in rows_of(pii.pii(df)):
        base = base_spans(texts[r["doc_id"]])
        said = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest(), texts[r["doc_id"]]
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[3] == k for x in base) for k in PLAIN]


def test_pii_added_spans_and_scores(spark, empty):
    text = "IBAN DE89370400440532013000, not DE88370400440532013000; pay GB82 WEST 1234 5698 7654 32 today. mail a@b.org"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = rows_of(pii.pii(df))[0]
    kinds = [s.split(":")[0] for s in r["spans"].split(",")]
    assert kinds == ["iban", "iban", "email"]
    scores = [float(x) for x in r["scores"].split(",")]
    assert scores[0] > 0.7 and len(scores) == 3            # a word close by raises the score
    low = rows_of(pii.pii(df, least_score=0.95))[0]
    assert "email" in low["spans"] and "iban" not in low["spans"]
    assert pii.pii(empty).count() == 0


@pytest.mark.parametrize("text, iban", [
    ("pay BE68 5390 0754 7034 BIC KREDBEBB", "BE68 5390 0754 7034"),
    ("ES91 2100 0418 4502 0005 1332 2024", "ES91 2100 0418 4502 0005 1332"),
    ("GB82WEST12345698765432 2024", "GB82WEST12345698765432"), ("NO93 8601 1117 947 USD", "NO93 8601 1117 947")])
def test_pii_iban_before_a_word_or_number(spark, text, iban):
    r = rows_of(pii.pii(spark.createDataFrame([(1, text)], "doc_id long, text string")))[0]
    at = text.index(iban)
    assert f"iban:{at}:{at + len(iban)}" in r["spans"].split(",")


def test_pii_context_words_decide_an_added_span(spark):
    texts = ["so DE89370400440532013000", "a sample DE89370400440532013000", "a sample iban DE89370400440532013000"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: "iban:" in r["spans"] for r in rows_of(pii.pii(df))} == {0: True, 1: False, 2: True}


# ------------------------------------------------------------------ op6

def test_language_id_on_held_out_rows(spark, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    rows = rows_of(language_id.language_id(df, train_rows=400))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_id_edge_cases(docs, empty):
    rows = rows_of(language_id.language_id(docs))
    assert len(rows) == len(fx.documents())
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (1000, 1001, 1002, 1003))
    assert language_id.language_id(empty).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in rows_of(language_id.language_id(unlabelled))} == {"und"}


def test_language_id_learns_every_language(spark):
    """More labels than training rows asked for; the rare ones have one row."""
    rows = [(i, f"w{chr(0x4e00 + i)} stone", f"l{i:03d}", None) for i in range(300)]
    rows += [(1000 + i, "river stone light", "l000", None) for i in range(200)]
    prepare(spark)
    model = language_id.train_model(fx.frame(spark, rows), train_rows=100, epochs=1)
    want = {lang for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert set(model[0]) == want and len(want) > 200
    assert all(model[1][:, k].any() for k in range(len(want)))


# ------------------------------------------------------------------ op7

@pytest.fixture(scope="module")
def reference_bpe():
    import base64

    import tiktoken
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_the_library_and_decodes(docs, empty, reference_bpe):
    import numpy as np
    want = set()
    for i, text, *_ in fx.documents():
        ids = reference_bpe.encode_ordinary(text or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((text or "").encode()).hexdigest()))
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(byte_bpe.digests(docs, RANKS))}
    assert got == want
    assert byte_bpe.digests(empty, RANKS).count() == 0


def test_scanner_on_odd_texts(reference_bpe):
    import numpy as np
    codec = byte_bpe.codec(RANKS)
    rng = random.Random(1)
    alphabet = "aB'strvemld  \n\t  é中1٣²!#  \x1c\x00😀ʼ_-'　\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(8000)]
    texts += ["a" * 3000 + " " * 3000 + "x", "'" * 300, "", "=+" * 2000, "'s't're've'm'll'd'sx''ll"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids, _ in codec.encode(texts)]
    assert got == [reference_bpe.encode_ordinary(t) for t in texts]


def test_offsets_and_slices_decode(spark):
    text = "Stone rivers' light, 12 copper\n\n windows é中"
    df = byte_bpe.encode_documents(spark.createDataFrame([(1, text, 7)], "doc_id long, text string, token_ids int"), RANKS)
    r = df.first()
    data = text.encode()
    ends = [*r.token_offsets[1:], len(data)]
    vocabulary = byte_bpe.codec(RANKS).vocabulary
    assert [vocabulary[i] for i in r.token_ids] == [data[a:b] for a, b in zip(r.token_offsets, ends)]
    assert bytes(df.select(byte_bpe.decode_udf(RANKS)("token_ids").alias("d")).first().d) == data


# ------------------------------------------------------------------ op10

def jaccard_groups(rows):
    sets = []
    for i, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in re.split(f"[{SPACE}]+", low) if x]
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    smallest = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            smallest[find(k)] = min(smallest.get(find(k), r[0]), r[0])
    return sorted((str(r[0]), len(sets[k]), str(smallest.get(find(k)) if sets[k] else r[0])) for k, r in enumerate(rows))


def joined(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in rows_of(ngram_join.similar_groups(df)))


def test_ngram_join_matches_brute_force(docs):
    assert joined(fx.clashing(docs)) == jaccard_groups(fx.documents())


def test_ngram_join_across_components_and_blocks(spark, monkeypatch):
    """Chains of near copies that no first vertex reaches, with tiny blocks and
    leaves and every shared shingle late in the order."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    monkeypatch.setattr(ngram_join, "HEAVY", 2)
    rng, rows = random.Random(9), []
    for g in range(6):
        text = fx.words(rng, 90)
        for k in range(12):
            rows.append((g * 100 + k, text, None, None))
            text = fx.near_copy(rng, text, rng.choice([1, 1, 2]))
    rng.shuffle(rows)
    want = jaccard_groups(rows)
    assert joined(fx.frame(spark, rows)) == want
    assert len({c for *_, c in want}) < len(rows)


def test_tree_bound_loses_no_pair():
    import numpy as np
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 1 << 63, rng.integers(5, 400)).astype(np.uint64) for _ in range(40)]
    sets = [np.unique(np.concatenate([b[:len(b) - rng.integers(0, 3)], rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64)]))
            for b in base for _ in range(4)]
    blobs = [ngram_join._point(s) for s in sets]
    forest = ngram_join._forest(np.array([len(s) for s in sets]), blobs, np.arange(len(sets)))
    assert len(forest) > 1
    found = {(min(i, j), max(i, j)) for a, b in ngram_join._forest_pairs(forest, forest, 80) for i, j in zip(a.tolist(), b.tolist())}
    # two halves give what lies across
    half = [ngram_join._forest(np.array([len(s) for s in sets]), blobs, np.arange(k, len(sets), 2)) for k in (0, 1)]
    across = {(min(i, j), max(i, j)) for a, b in ngram_join._forest_pairs(*half, 80) for i, j in zip(a.tolist(), b.tolist())}
    assert across == {(i, j) for i, j in found if (i + j) % 2}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert (j, i) in found
    assert len(found) < len(sets) ** 2 / 8


def test_a_similarity_that_would_lose_pairs_is_refused(empty):
    with pytest.raises(ValueError, match="under 50"):
        ngram_join.similar_groups(empty, similarity=49)


def test_keep_one_of_each_group(docs, empty):
    kept = ngram_join.keep_one(fx.clashing(docs))
    assert kept.columns == fx.clashing(docs).columns
    leads = {i for i, _, c in jaccard_groups(fx.documents()) if i == c}
    assert {str(r["doc_id"]) for r in rows_of(kept)} == leads
    assert ngram_join.similar_groups(empty).count() == 0 and ngram_join.keep_one(empty).count() == 0


def test_finer_points_never_miss_an_overlap():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2 ** 64, n, np.uint64)) for n in (1, 5, 7, 8, 9, 60, 64, 65, 300, 1000, 1100)]
    sets += [np.unique(np.concatenate([s[:len(s) * 9 // 10], rng.integers(0, 2 ** 64, 1 + len(s) // 8, np.uint64)])) for s in sets]
    sizes = np.array([len(s) for s in sets])
    fine = ngram_join.FinePoints(sizes, [ngram_join._bits(s) for s in sets])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    bound = fine.overlap(i, j)
    assert (bound >= both).all() and (bound <= np.minimum(sizes[i], sizes[j])).all()
    assert (bound[i == j] == sizes).all()
    assert all(ngram_join._similar(sets[a], sets[b], t) == (100 * n >= t * (len(sets[a]) + len(sets[b]) - n))
               for a, b, n in zip(i, j, both) for t in (50, 80, 100))


def test_a_group_of_copies_gives_fewer_links_than_members():
    """A hundred near copies under three shingles, all alike: a row each at
    most comes through, and a spanning tree of links over all cells."""
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2 ** 64, 200, np.uint64))
    sets = [np.unique(np.concatenate([base[5:], rng.integers(0, 2 ** 64, 5, np.uint64)])) for _ in range(100)]
    rows = pd.DataFrame([(token, 0, 0, 0, 0, v, v, len(s), ngram_join._point(s), ngram_join._bits(s), s.tobytes())
                         for token in (1, 2, 3) for v, s in enumerate(sets)],
                        columns=["token", "low", "x", "y", "blk", "v", "c", "n", "point", "bits", "hashes"])
    met = ngram_join._met(rows, 80)
    assert len(met) == len(rows)
    links = ngram_join._tied(rows, 80)
    assert len(links) == 99 and set(links["a"]) | set(links["b"]) == set(range(100))
    far = rows[(rows["v"] < 2) | (rows["token"] == 9)].assign(c=4)
    assert not len(ngram_join._met(far, 80)) and not len(ngram_join._tied(far, 80))


def test_keep_one_decides_row_by_row(spark):
    """Near copies without an id, under one id, as repeated rows and with
    clashing columns: one of each group stays, all that stand alone stay."""
    prepare(spark)
    rng = random.Random(8)
    one, two, alone = (fx.words(rng, 80) for _ in range(3))
    rows = [(None, one, "en", "a"), (None, one, "en", "a"), (None, fx.near_copy(rng, one, 1), "en", "b"),
            (7, two, "en", "a"), (7, fx.near_copy(rng, two, 1), "en", "b"), (7, two, "en", "a"),
            (9, one + " x", "en", "c"), (7, alone, "en", "d"), (None, None, "en", "e"), (None, "", "de", "f"), (3, None, None, "g")]
    kept = ngram_join.keep_one(fx.clashing(fx.frame(spark, rows)))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.source) for r in kept.collect())
    stay = [(3, "g"), (7, "d"), (9, "c"), (None, "e"), (None, "f")]
    assert [x for x in got if x[2] in "cdefg"] == sorted((i is None, i or 0, s) for i, s in stay)
    rest = [x for x in got if x[2] in "ab"]
    assert len(rest) == 1 and rest[0][1] == 7
    assert kept.columns == fx.clashing(fx.frame(spark, rows)).columns
    assert ngram_join.keep_one(fx.frame(spark, [])).count() == 0


def test_near_copies_hash_each_text_once_a_pass(spark, monkeypatch):
    """No plan of the join runs its Python step twice over the same texts."""
    runs = {}

    def counted(df, name, stored=ngram_join.stored):
        plan = df._jdf.queryExecution().executedPlan().toString()
        runs[name] = max(runs.get(name, 0), plan.count("ArrowEvalPython"))
        return stored(df, name)
    monkeypatch.setattr(ngram_join, "stored", counted)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join([*words, "more"]), " ".join(words[::-1]), "", None]
    rows = ngram_join.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
    assert runs["op10-vertices"] == runs["op10-sets"] == runs["op10-members"] == 1
