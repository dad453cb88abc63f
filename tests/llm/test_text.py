"""Language identification, unigram pieces, quality and toxicity."""

import itertools

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import plain
from tidemark.llm import folds, langid, quality, queries, toxicity, unigram

CASES = [(1, None), (2, ""), (3, "123 !!! \n"), (4, "the the the"), (4, "the the the"), (None, "and of the"), (6, "x" * 200_000), (7, "a\x00b 日本 𝔘")]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame([(i, t, "en", 1, 0.5) for i, t in CASES], "doc_id long, text string, lang string, held_out int, score double")


def test_folds(spark):
    import zlib
    got = spark.range(50).select("id", folds.fold("id").alias("f"), folds.held_out("id").alias("h")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 and r.h == (r.f == 0) for r in got)


def test_language_held_out(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op5_langid(spark, SF_ORACLE).collect()
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    tested = [r for r in got if r.held_out and lang[r.doc_id]]
    assert len(tested) > 100 and sum(r.lang_pred == lang[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_language_backoff():
    model = langid.Model([{"lang": a, "n": n, "gram": g, "count": c} for a, n, g, c in [
        ("x", 0, "abc", 5), ("y", 0, "abd", 5), ("x", 2, "^a", 1), ("y", 2, "zz", 3), ("x", 1, "q", 9), ("y", 1, "q", 1)]], 2)
    by = lambda w: dict(zip(model.langs, model.word(w)))
    assert by("abc")["x"] > by("abc")["y"] and by("abd")["y"] > by("abd")["x"]  # whole words first
    assert by("ar")["x"] > by("ar")["y"] and by("ozz")["y"] > by("ozz")["x"]  # then the longest known grams
    assert by("q")["x"] > by("q")["y"] and not any(by("ü").values())  # then shorter ones, then nothing


def test_language_cases(spark, cases):
    got = [(r.doc_id, r.held_out, r.lang_pred) for r in langid.identify(cases).collect()]
    assert sorted(got, key=str) == sorted([(i, folds_of(i), "und" if not any(c.isalpha() for c in t or "") else "en") for i, t in CASES], key=str)
    assert langid.identify(cases.limit(0)).collect() == []
    unknown = langid.identify(cases.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def folds_of(i):
    import zlib
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def pieces():
    return unigram.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def best_path(p, text):
    """Plain Viterbi over the whole text."""
    index = {s: i for i, s in enumerate(p.strings) if i not in p.byte_ids and i > 2}
    s = unigram.MARK + text.replace(" ", unigram.MARK)
    best, came = [0.0] + [-np.inf] * len(s), [None] * (len(s) + 1)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + 50) + 1):
            k = index.get(s[i:j])
            cost = p.scores[k] if k is not None else p.unknown if j == i + 1 else None
            if cost is not None and best[i] + cost > best[j]:
                best[j], came[j] = best[i] + cost, (i, k)
    ids, j = [], len(s)
    while j:
        i, k = came[j]
        ids[:0] = [k] if k is not None else [p.byte_ids[c] for c in s[i:j].encode()]
        j = i
    return ids, best[-1]


def cost(p, ids):
    return sum(p.scores[i] for i in ids)


def test_pieces_against_plain_viterbi(spark, pieces):
    texts = [r.text[:1500] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(25).collect()]
    texts += ["x", " ", "  a   b ", "日本語 ñ\n\n𝔘\t", "▁", "\n", "ab" * 60, "$$$ %%%%"]
    coder = unigram.Coder(pieces)
    for t, data in zip(texts, coder.encode(texts)):
        mine, (want, _) = np.frombuffer(data, "<i4").tolist(), best_path(pieces, t)
        assert mine == want or abs(cost(pieces, mine) - cost(pieces, want)) < 1e-9  # equal paths may differ
        assert coder.decode(mine) == t.replace("▁", " ")


def test_pieces_are_those_of_the_library(spark, pieces):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto = pb.ModelProto.FromString(f.read())
    for i, piece in enumerate(proto.pieces):
        piece.score = float(pieces.scores[i])
    proto.trainer_spec.model_type = 1
    sp = SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    mine = [np.frombuffer(x, "<i4").tolist() for x in unigram.Coder(pieces).encode(texts)]
    theirs = sp.encode(texts)
    assert sum(a == b for a, b in zip(mine, theirs)) >= 0.9 * len(texts)
    assert all(len(a) == len(b) and abs(cost(pieces, a) - cost(pieces, b)) < 1e-2 for a, b in zip(mine, theirs))


def test_unigram_query_and_cases(spark, pieces, cases):
    got = queries.op10_unigram(spark, SF_SMALL)
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count() and got.where("not round_trip").count() == 0
    out = unigram.decode(unigram.encode(cases.withColumn("ids", F.lit("clash")), pieces), pieces).collect()
    assert [(r.doc_id, r.decoded) for r in out] == [(i, t or "") for i, t in CASES]
    assert [len(r.ids) for r in out][:2] == [0, 0] and out[0].lang == "en"
    assert unigram.encode(cases.limit(0), pieces).collect() == []


def held_out(spark, query, label):
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    got = query(spark, SF_ORACLE).collect()
    assert len(got) == spark.read.parquet(f"{SF_ORACLE}/documents.parquet").count() and all(0 <= r.score <= 1 for r in got)
    return [(r.score, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]


def test_quality_held_out(spark):
    pairs = held_out(spark, queries.op8_quality, "quality")
    assert plain.auc(*zip(*pairs)) > 0.95
    assert sum((s >= 0.3) == (y == 1) for s, y in pairs) >= 0.9 * len(pairs)


def test_toxicity_held_out(spark):
    assert plain.auc(*zip(*held_out(spark, queries.op1_toxicity, "toxic"))) > 0.75


def test_statistics_are_of_whole_texts():
    assert quality.statistics(None) == quality.statistics(" \n") == [0.0] * len(quality.STATISTICS)
    x = dict(zip(quality.STATISTICS, quality.statistics("ab ab ab.\nab ab ab.\n12 !!")))
    assert x["distinct_lines"] == pytest.approx(2 / 3) and x["repeats"] == pytest.approx(2 / 8) and x["ends"] == 1.0
    assert x["digit"] == pytest.approx(2 / 25)


def test_sums_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i % 3), float(i % 2), rng.random(len(quality.STATISTICS)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "fold long, y double, x array<float>").repartition(7)
    d = len(quality.STATISTICS)
    features = quality.Features([0.5] * d, [0.3] * d, 8, 4.0, 1)
    one = quality.normal_equations(df, features, 90)
    monkeypatch.setattr(quality, "TASK_ROWS", 20)
    many = quality.normal_equations(df, features, 90)
    z = features(np.array([x for _, _, x in rows], np.float32).astype(float))
    for f in range(3):
        own = np.arange(90) % 3 == f
        want = z[own].T @ np.column_stack((z[own], (np.arange(90) % 2)[own]))
        assert np.allclose(one[f], want) and np.allclose(many[f], want)


def test_classifier_cases(spark, cases):
    labels = spark.createDataFrame([(i, y, 0, "x") for i, y in [(1, 0), (2, 1), (3, 0), (4, 1), (6, None), (None, 1), (99, 1), (3, 1), (7, 1)]],
                                   "doc_id long, quality int, toxic int, text string")
    got = quality.score(cases, labels, keep=("lang",)).collect()
    assert len(got) == len(CASES) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.lang == "en" for r in got)
    assert {r.score for r in quality.score(cases, labels.limit(0)).collect()} == {0.5}
    assert quality.score(cases.limit(0), labels).collect() == []
    chain = {"poor": "1 - quality", "toxic": "toxic"}
    got = toxicity.classify(cases, labels, chain, decide="toxic", keep=("lang",), max_iter=5, min_rows=1).collect()
    assert len(got) == len(CASES) and {r.predicted for r in got} == {0} and all(0 <= r.p_poor <= 1 for r in got)
    assert {(r.score, r.predicted) for r in toxicity.classify(cases, labels.limit(0), chain, decide="toxic").collect()} == {(0.5, 0)}
    assert toxicity.classify(cases.limit(0), labels, chain, decide="toxic").collect() == []


def test_chain_feeds_earlier_probabilities(spark):
    """The second category follows the first one's words with an effect only the first model's output carries well."""
    words = [("good", 0, 0), ("bad", 1, 0), ("vile", 1, 1)]
    rows = [(i, f"{w} filler{i % 3}", a, b) for i in range(240) for w, a, b in [words[i % 3]]]
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, a, b) for i, _, a, b in rows], "doc_id long, a int, b int")
    links, _ = toxicity.fit(docs, labels, {"a": "a", "b": "b"}, max_iter=20)
    assert links[1][0][toxicity.SIZE] > 0  # a higher first probability makes the second category likelier
    got = toxicity.predict(docs, links, ["a", "b"]).collect()
    assert all((r.p_a > 0.5) == (rows[r.doc_id][2] == 1) and (r.p_b > 0.5) == (rows[r.doc_id][3] == 1) for r in got)


def test_links_are_fitted_out_of_fold(spark):
    """Each part's model is the one of least penalised loss for the rows of the other folds alone."""
    rng = np.random.default_rng(5)
    rows = [(int(f), float(y), sorted({0, *(rng.integers(1, 30, 6) + 9 * y).astype(int).tolist()})) for f, y in zip(rng.integers(0, 3, 120), rng.integers(0, 2, 120))]
    packed = [(f, y, bytearray(toxicity.packed(np.array(ix, int)))) for f, y, ix in [*rows, (1, 1.0, [])]]
    assert [toxicity.unpacked(bytes(x)).tolist() for _, _, x in packed] == [*[ix for _, _, ix in rows], []]
    df = spark.createDataFrame(packed, "fold int, y0 double, ix binary")
    got = toxicity._fit_link(df, 0, [toxicity.WHOLE, 0, 1, 2], {}, 1e-2, 200, 1)
    assert set(got) == {toxicity.WHOLE, 0, 1, 2}
    for part, (w, constant) in got.items():
        own = [(set(ix), y) for f, y, ix in [*rows, (1, 1.0, [])] if f != part]
        x, y = np.array([[i in ix for i in range(40)] for ix, _ in own], float), np.array([y for _, y in own])
        off = 1 / (1 + np.exp(-(x @ w[:40] + constant))) - y
        assert abs(x.T @ off / len(y) + 1e-2 * w[:40]).max() < 2e-3 and abs(off.mean()) < 2e-3 and not w[40:].any()


def test_training_moves_features_and_no_texts(spark):
    """Features meet the labels in the fit alone, with repeated ids, labels of no document and several groups."""
    docs = spark.createDataFrame([(i, f"{'good' if i % 2 else 'bad'} word{i % 7}") for i in [*range(1, 90), 5, 6]], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(1, 80), 7, 8, *range(200, 240)]], "doc_id int, a int")
    rows, groups = toxicity._train_rows(docs, labels, "doc_id", "text", {"a": "a"}, 30, 3)
    known = toxicity._label_rows(docs, labels, "doc_id", {"a": "a"}).select(toxicity._group(groups), "*")
    assert groups > 1 and rows.columns == ["grp", "key", "fold", "ix"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Join" in x and "BroadcastHashJoin" not in x]
    rows, known = toxicity.stored(rows, "test"), toxicity.stored(known, "test")
    joined = rows.join(known.drop("grp"), "key")
    assert joined.count() > known.join(docs.select("doc_id").distinct(), known["key"] == docs["doc_id"]).count() / 2
    parts = [toxicity.WHOLE, 0, 1, 2]
    apart = toxicity._fit_link(rows, 0, parts, {}, 1e-2, 60, 1, groups, known)
    whole = toxicity._fit_link(joined, 0, parts, {}, 1e-2, 60, 1, groups)
    assert set(apart) == set(whole) == set(parts)
    assert all(np.allclose(apart[p][0], whole[p][0], atol=1e-3) and abs(apart[p][1] - whole[p][1]) < 1e-3 for p in parts)


def test_products_read_in_parts_are_the_same(monkeypatch):
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.choice(20, n, replace=False)) for n in (0, 5, 20, 0, 3, 1, 0)]
    ends, beside, w = np.concatenate(([0], np.cumsum([len(x) for x in sets]))), rng.random((7, 2)), rng.random(22)
    dense = np.array([[i in x for i in range(20)] for x in sets], float)
    for read in (1, 4, 1000):
        monkeypatch.setattr(toxicity, "READ", read)
        rows = toxicity.Rows(np.concatenate(sets), ends, beside, 20)
        assert np.allclose(rows.times(w), np.hstack([dense, beside]) @ w)
        assert np.allclose(rows.summed(w[:7]), np.hstack([dense, beside]).T @ w[:7])
    none = toxicity.Rows(np.empty(0, int), np.array([0, 0]), np.zeros((1, 0)), 20)
    assert none.times(np.ones(20)).tolist() == [0.0] and not none.summed(np.ones(1)).any()


@pytest.mark.parametrize("beta", [0.5, 1.0, 2.0])
def test_threshold_is_where_f_is_best(beta):
    p, y = np.array([0.1, 0.2, 0.2, 0.6, 0.8, 0.9]), np.array([0, 0, 1, 1, 0, 1.0])
    best = toxicity.best_threshold(p, y, beta)
    f = lambda t: (1 + beta**2) * y[p >= t].sum() / max(1, (p >= t).sum() + beta**2 * y.sum())
    assert f(best) == pytest.approx(max(f(t) for t in np.linspace(0, 1, 101))) and best not in p
    assert toxicity.best_threshold(p, np.zeros(6)) == 0.5 and toxicity.best_threshold(np.array([0.3, 0.3]), np.array([0, 1.0])) == 0.3


def test_learned_threshold_with_odd_rows(spark, cases):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(8)], "doc_id long, quality int, toxic int")
    chain = {"poor": "1 - quality", "toxic": "toxic"}
    got = toxicity.classify(cases, labels, chain, decide="toxic", threshold=None, min_rows=1).collect()
    assert len(got) == len(CASES) and all(r.predicted in (0, 1) and 0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in toxicity.classify(cases, labels.limit(0), chain, decide="toxic", threshold=None).collect()} == {0}


def test_every_word_of_the_training_rows_is_kept(spark):
    words = ["".join(x) for x in itertools.product("abcdefghij", repeat=5)][:30_000]
    rows = [(i, lang, text) for i in range(0, 60, 2) for lang, text in (("en", " ".join(words) + " common"), ("fr", "common"))]
    rows = [(i + (lang == "fr"), lang, text) for i, lang, text in rows]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    used = {r.lang: r["count"] for r in docs.where(~folds.held_out("doc_id")).groupBy("lang").count().collect()}
    model = langid.learn(docs)
    index, logs = model.tables[0]
    assert model.langs == ["en", "fr"] and set(index) == {*words, "common"}
    for w, en, fr in ((words[-1], used["en"], 0), ("common", used["en"], used["fr"])):
        want = [np.log((en + 0.5) / (used["en"] * 30_001 + 0.5 * 30_002)), np.log((fr + 0.5) / (used["fr"] + 0.5 * 30_002))]
        assert np.allclose(logs[index[w]], want)


def test_numerals_are_no_letters(spark):
    rows = [(i, f"hello world number {i}", "en") for i in range(20)] + [(20 + i, f"bonjour le monde {i}", "fr") for i in range(20)]
    rows += [(100, "½ ² ⁵", None), (101, "Ⅷ 123 _", None), (102, "hello²", None), (103, "²bonjour½le", None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100] == got[101] == ("und", 0.0)
    assert got[102][0] == "en" and got[103][0] == "fr"
    assert langid.words_of("a²b ½ c_d") == ["a", "b", "c", "d"]


def test_decoding_in_the_same_pass(spark):
    pieces = unigram.load_pieces(queries.vocabulary("piece_bpe_32k.model"))
    df = spark.createDataFrame([(1, "Hello  wörld \u2581x\n"), (2, None), (3, "")], "doc_id long, text string")
    two = unigram.decode(unigram.encode(df, pieces), pieces).orderBy("doc_id").collect()
    assert unigram.encode(df, pieces, decoded_col="decoded").orderBy("doc_id").collect() == two


def test_toxicity_learns_from_all_rows_in_groups(spark):
    """More rows than a task holds: none is left out, and the groups' models together tell the words apart."""
    docs = spark.createDataFrame([(i, f"{'vile' if i % 3 == 0 else 'good'} filler{i % 5}") for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    rows, groups = toxicity._train_rows(docs, labels, "doc_id", "text", {"toxic": "toxic"}, 60, 3)
    known = labels.where(~folds.held_out("doc_id")).count()
    assert rows.count() == known and groups == -(-known // 60) > 1
    got = toxicity.classify(docs, labels, {"toxic": "toxic"}, decide="toxic", threshold=None, task_rows=60).collect()
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in got)


def test_threshold_of_counted_rows():
    p, y = np.array([0.1, 0.2, 0.2, 0.6, 0.8, 0.9]), np.array([0, 0, 1, 1, 0, 1.0])
    counted = toxicity.best_threshold(np.array([0.2, 0.9, 0.6, 0.1, 0.8]), np.array([1.0, 1, 1, 0, 0]), rows=np.array([2, 1, 1, 1, 1]))
    assert counted == toxicity.best_threshold(p, y)
