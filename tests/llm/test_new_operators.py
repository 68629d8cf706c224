"""SentencePiece pieces, whitening and fill-in-middle against the library,
numpy and brute force."""

import hashlib
import random
import re

import fixtures as fx
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from ledgerlens.llm import fill_in_middle as fim
from ledgerlens.llm import piece_tokens, whitening
from ledgerlens.llm.common import prepare

PIECES = public_tokenizers.path("piece_bpe_32k.model")
EDGES = ["", " ", "   ", "a", " a", "a ", "  a  ", "▁", "▁▁a", "a▁ ", "\x00", "<s></s><0x0A><unk>", "x" * 5000, " " * 3000,
         "é" * 500, "​☃😀", "a\r\n\tb", "ﬁ①½ﷺ", "がが", "q" * 63 + "w", "#$%" * 400]


def odd_texts(n=600):
    rng = random.Random(3)
    alphabet = "ab  c\n\t▁éßﬁ①½ﷺ한국あア゛ガ̈é☃😀​ 　ＡＢ<s></s><0x0A>\x00\r'-"
    return EDGES + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


# ------------------------------------------------------------------ op11

def model_with_map(folder, rule, shorten, prefix):
    """The given model under another normaliser: the library's own maps."""
    m, n = proto.ModelProto(), proto.ModelProto()
    with open(PIECES, "rb") as f:
        m.ParseFromString(f.read())
    n.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    m.normalizer_spec.precompiled_charsmap = n.normalizer_spec.precompiled_charsmap
    m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.add_dummy_prefix = shorten, prefix
    path = folder / f"{rule}-{shorten}-{prefix}.model"
    path.write_bytes(m.SerializeToString())
    return str(path)


def against_library(path, texts):
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_tokens.PieceModel(path)
    for t in texts:
        ids, starts, ends = own.framed(t)
        want = [library.bos_id(), *library.encode(t, num_threads=1), library.eos_id()]
        assert ids.tolist() == want, t[:80]
        assert own.decode(want) == library.decode(want), t[:80]
        pieces = library.encode(t, return_type="proto").pieces
        assert list(zip(starts.tolist(), ends.tolist()))[1:-1] == [(p.begin, p.end) for p in pieces], t[:80]


def test_pieces_and_spans_equal_the_library():
    against_library(PIECES, odd_texts() + [t or "" for _, t, *_ in fx.documents()])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("shorten", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_compiled_character_maps_equal_the_library(tmp_path, rule, shorten, prefix):
    against_library(model_with_map(tmp_path, rule, shorten, prefix), odd_texts())


def test_decoding_of_any_ids_equals_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), piece_tokens.PieceModel(PIECES)
    rng = random.Random(5)
    for _ in range(800):
        low = rng.choice([0, 3, 259])
        ids = [rng.randrange(low, rng.choice([260, 300, 32_000])) for _ in range(rng.randrange(12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_a_cache_of_fixed_size_gives_the_same_ids(monkeypatch):
    plain = piece_tokens.PieceModel(PIECES)
    texts = [t or "" for _, t, *_ in fx.documents()]
    want = [plain.framed(t)[0].tolist() for t in texts]
    monkeypatch.setattr(piece_tokens, "CACHE_BYTES", 20_000)
    small = piece_tokens.PieceModel(PIECES)
    for t, ids in zip(texts, want):
        assert small.framed(t)[0].tolist() == ids
        assert len(small.merged) + len(small.merged.older) < 200
        assert all(len(k) <= piece_tokens.CACHED_CHARS for k in small.merged)


def test_models_that_break_the_cuts_are_refused(tmp_path):
    m = proto.ModelProto()
    with open(PIECES, "rb") as f:
        m.ParseFromString(f.read())
    m.pieces[500].type = proto.ModelProto.SentencePiece.USER_DEFINED
    (tmp_path / "own.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        piece_tokens.PieceModel(str(tmp_path / "own.model"))


def test_piece_digests_of_the_fixture(spark):
    prepare(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = fx.documents()
    got = piece_tokens.digests(fx.clashing(fx.frame(spark, rows)), PIECES)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
    want = []
    for i, t, *_ in rows:
        ids = [library.bos_id(), *library.encode(t or "", num_threads=1), library.eos_id()]
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, (tuple(r)[:4] for r in got.collect()))) == sorted(map(repr, want))
    assert piece_tokens.digests(fx.frame(spark, []), PIECES).count() == 0


def test_encoded_documents_carry_spans_and_decode(spark):
    prepare(spark)
    docs = fx.clashing(fx.frame(spark, fx.documents()))
    out = piece_tokens.encode_documents(docs.withColumn("piece_ids", docs.n), PIECES)
    assert out.columns == [*docs.columns, *piece_tokens.ADDED]
    texts = out.select("text", "piece_starts", "piece_ends",
                       piece_tokens.decode_udf(PIECES)("piece_ids").alias("back")).collect()
    for r in texts:
        assert r.back == (r.text or "")
        data = (r.text or "").encode()
        assert b"".join(data[a:b] for a, b in zip(r.piece_starts, r.piece_ends)) == data


# ------------------------------------------------------------------ op12

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_whitening(rows, components=16):
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    size = max(len(v) for _, v in good)
    good = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in good if len(v) == size]
    own = sorted({tuple(v) for _, v in good})
    n, sums = len(own), [sum(c) for c in zip(*own)]
    x = np.array(own, float) - np.array([s / n for s in sums])
    e, u = np.linalg.eigh(x.T @ x / n)
    order = [j for j in np.argsort(-e)[:components] if e[j] > 1e-10 * e.max()]
    e, u = e[order], u[:, order]
    trace = (x ** 2).sum() / n
    return {(i, k + 1): (n, sum((n * c - s) ** 2 for c, s in zip(v, sums)),
                         float((np.array(v) - np.array([s / n for s in sums])) @ u[:, k] / np.sqrt(e[k])), e[k] / trace)
            for i, v in good for k in range(len(e))}


def against_numpy(got, want, components):
    rows = {(r.vec_id, r.component): r for r in got}
    assert set(rows) == set(want)
    for k in range(1, components + 1):
        keys = [x for x in want if x[1] == k]
        if keys:
            lead = max(keys, key=lambda x: abs(want[x][2]))
            sign = np.sign(rows[lead].whitened * want[lead][2])
            for x in keys:
                assert abs(rows[x].whitened - sign * want[x][2]) < 1e-7
                assert rows[x].n == want[x][0] and rows[x].deviation == want[x][1]
                assert abs(rows[x].explained / want[x][3] - 1) < 1e-9 and 0 <= rows[x].identity_error < 1e-8


def vectors(n=400, size=40, seed=2):
    rng = np.random.default_rng(seed)
    spread = np.linspace(2.0, 0.3, size)
    rows = [(i, (rng.standard_normal(size) * spread).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]                       # a third are copies of one vector
    bad = [None, [], [None] + rows[1][1][1:], [float("nan")] + rows[1][1][1:], [float("inf")] + rows[1][1][1:],
           rows[2][1][:-1], rows[3][1]]
    return rows + [(2000 + i, v) for i, v in enumerate(bad)]


def test_whitening_equals_numpy(spark):
    prepare(spark)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).repartition(5)
    from pyspark.sql import functions as F
    clash = table.withColumns({c: F.lit(3) for c in ("x", "n", "i", "_c", "component", "whitened", "a.b")})
    got = whitening.whiten(clash).collect()
    against_numpy(got, brute_whitening(rows), 16)
    assert len({r.identity_error for r in got}) == 1


def test_whitening_of_the_given_table(spark):
    table = prepare(spark).read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    against_numpy(whitening.whiten(table).collect(), brute_whitening(rows), 16)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_without_variance_gives_no_rows(spark, rows):
    prepare(spark)
    assert whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)).count() == 0


def test_whitening_of_few_dimensions_and_flat_directions(spark):
    prepare(spark)
    rng = np.random.default_rng(1)
    rows = [(i, [a, b, a, 0.5]) for i, (a, b) in enumerate((rng.standard_normal((50, 2)) * 3).tolist())]
    rows.append((None, rows[0][1]))
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 2 * 51
    against_numpy([r for r in got if r.vec_id is not None],
                  {k: v for k, v in brute_whitening(rows).items() if k[0] is not None}, 2)


@pytest.mark.parametrize("spectrum", ["flat tail", "low rank", "steep", "close"])
def test_eigenpairs_of_many_spectra(spectrum):
    size = 200
    e = {"flat tail": np.concatenate([np.linspace(70, 66, 16), np.linspace(61, 53, size - 16)]),
         "low rank": np.concatenate([np.linspace(9, 1, 20), np.zeros(size - 20)]),
         "steep": np.geomspace(1e6, 1e-6, size),
         "close": np.linspace(10, 5, size)}[spectrum]
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((size, size)))[0]
    v = (q * e) @ q.T
    passes = []

    def apply(block):
        passes.append(block.shape[1])
        return v @ block
    values, vectors_ = whitening.top_eigenpairs(apply, size, 16)
    assert np.allclose(values, e[:16], rtol=1e-11)
    assert np.abs(np.abs((q[:, :16] * vectors_).sum(axis=0)) - 1).max() < 1e-9
    assert max(passes) <= 16 + whitening.GUARD + whitening.BOUND and len(passes) < 200


def test_deviations_are_exact_or_null():
    sums = np.array([3 * 10 ** 6 + 1, 10 ** 6], dtype=object)
    x = np.array([[10 ** 6, 10 ** 6], [10 ** 6 + 7, 5], [3 * 10 ** 9, 0], [2 ** 61, 1]])
    want = [sum((3 * int(c) - int(s)) ** 2 for c, s in zip(r, sums)) for r in x]
    assert whitening._deviations(x, 3, sums) == [w if w < 2 ** 63 else None for w in want]


# ------------------------------------------------------------------ op13

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark):
    prepare(spark)
    rows = [(i, t) for i, t, *_ in fx.documents()]
    rows += [(5000 + i, t) for i, t in enumerate(odd_texts(200) + ["a<P>b", "<S>", "x<M>", "<", "a<S", "<P", "A1b2" * 900])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.fill_in_middle(fx.clashing(table).withColumn("output", table.doc_id)).collect()
    want = sorted(repr((i, *brute_fim(i, t))) for i, t in rows)
    assert sorted(repr((r.doc_id, *r[-5:])) for r in out) == want
    assert all(fim.restore(r.output, r.form) == (r.text or "") for r in out)
    digests = fim.digests(fx.clashing(table)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(repr, map(tuple, digests))) == sorted(
        repr((i, *brute_fim(i, t)[:4], sha(brute_fim(i, t)[4]), sha(t or ""))) for i, t in rows)
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ranks_of_the_wavelet_matrix():
    rng = np.random.default_rng(4)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 3, size).astype(np.uint8)
        matrix, places = fim.WaveletMatrix(symbols, 2), np.arange(size + 1)
        for c in range(3):
            assert (matrix.rank(c, places) == np.concatenate([[0], np.cumsum(symbols == c)])).all()


def test_a_batch_of_many_texts_cuts_each_alone(monkeypatch):
    monkeypatch.setattr(fim, "BATCH_CHARS", 100)
    texts, rng = odd_texts(100), np.random.default_rng(6)
    a, b = rng.integers(0, 2 ** 32, len(texts)), rng.integers(0, 2 ** 32, len(texts))
    n, i, j = fim.unit_cuts(texts, a, b)
    for t, x, y, units, p, q in zip(texts, a.tolist(), b.tolist(), n, i, j):
        own = UNIT.findall(t)
        low, high = sorted((x % (len(own) + 1), y % (len(own) + 1)))
        assert (units, p, q) == (len(own), len("".join(own[:low])), len("".join(own[:high])))
    assert [len(x) for x in fim.unit_cuts([], a[:0], b[:0])] == [0, 0, 0]
