"""Language identification, pseudo-likelihood scores and fingerprints."""

import dataclasses
import hashlib
import inspect
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from knnspark.llm import langid, pseudo_lm, syncmers
from knnspark.llm.words import WordHasher
from tests.conftest import SF_CHECK
from tests.llm.helpers import AWKWARD, DOCS, EXTRA, docs_df


# ---------------------------------------------------------------- language identification

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.learn(langid.learned_from(docs))
    rows = langid.identify(docs, model).select("*", langid.held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r.out]
    assert len(out) > 150 and sum(r.lang == r.lang_pred for r in out) >= 0.99 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_texts_and_columns(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), (None, "en"), ("x", None)], "text string, lang string")
    model = langid.learn(train)
    assert model.languages == ["en", "fr"]
    got = langid.identify(docs_df(spark, AWKWARD + [(20, "the and the"), (21, "chienne")], EXTRA + ["lang_pred"]), model)
    assert [c for c in got.columns if c not in ("lang_pred", "score")] == ["doc_id", "text", *(c for c in EXTRA if c != "score")]
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[k].lang_pred for k in (1, 2, 3, 4, 20, 21)] == ["und"] * 4 + ["en", "fr"]
    assert rows[1].score == 0 and got.count() == len(AWKWARD) + 2
    nothing = langid.learn(train.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(docs_df(spark, AWKWARD), nothing).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], DOCS), model).collect() == []


def test_a_rare_language_is_learned_whole(spark):
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 6)))
    rows = [(" ".join(word("abcdefgh") for _ in range(12)), "common") for _ in range(3000)]
    rare = [(" ".join(word("opqrstuv") for _ in range(12)), "rare") for _ in range(20)]
    model = langid.learn(spark.createDataFrame(rows + rare, "text string, lang string").repartition(4), max_docs=100)
    assert model.languages == ["common", "rare"] and np.allclose(np.exp(model.prior), [3000 / 3020, 20 / 3020])
    known = {w for t, _ in rare for w in t.split()}
    assert {w for w in known if sum(t.split().count(w) for t, _ in rare) > 1} <= set(model.words)
    assert all(model.predict(t)[0] == "rare" for t, _ in rare) and all(model.predict(t)[0] == "common" for t, _ in rows[:50])


def test_prediction_equals_brute_force(spark):
    """Counts, smoothing and back-off recomputed from the labelled texts, word by word."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.learn(langid.learned_from(docs))
    rows = docs.collect()
    learned = [r for r in rows if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang and r.text]
    words, grams, sizes = {}, {}, {}
    for r in learned:
        sizes[r.lang] = sizes.get(r.lang, 0) + 1
        for w in langid.words_of(r.text):
            words.setdefault(w, {}).setdefault(r.lang, 0)
            words[w][r.lang] += 1
    for w, by in words.items():
        for g in langid.grams_of(w):
            for lang, n in by.items():
                grams.setdefault(g, {}).setdefault(lang, 0)
                grams[g][lang] += n
    langs = sorted(sizes)
    assert model.languages == langs and np.allclose(model.prior, np.log([sizes[c] / len(learned) for c in langs]))

    def row(unit, table, same):
        of = [(u, by) for u, by in table.items() if same(u)]
        return [np.log((table[unit].get(c, 0) + 0.1) / (sum(by.get(c, 0) for _, by in of) + 0.1 * max(1, sum(c in by for _, by in of)))) for c in langs]

    assert set(model.words) == {w for w, by in words.items() if sum(by.values()) >= 2}
    assert set(model.grams) == {g for g, by in grams.items() if sum(by.values()) >= 3}
    rng = random.Random(1)
    for w in rng.sample(model.words, 25):
        assert np.allclose(model.word_rows[model.words.index(w)], row(w, words, lambda u: True), atol=1e-5)
    for g in rng.sample(model.grams, 25):
        assert np.allclose(model.gram_rows[model.grams.index(g)], row(g, grams, lambda u, n=len(g): len(u) == n), atol=1e-5)
    known = {w: model.word_rows[k].astype(float) for k, w in enumerate(model.words)}
    short = {g: model.gram_rows[k].astype(float) for k, g in enumerate(model.grams)}
    for r in rng.sample([r for r in rows if r.text and len(r.text) < 3000], 40):
        total = model.prior.copy()
        for w in langid.words_of(r.text):
            if w in known:
                total = total + known[w]
                continue
            marked = f"<{w}>"
            ends = [next((short[marked[e - n:e]] for n in (4, 3, 2, 1) if n <= e and marked[e - n:e] in short), None) for e in range(2, len(marked) + 1)]
            ends = [e for e in ends if e is not None]
            total = total + (np.mean(ends, axis=0) if ends else 0)
        lang, score = model.predict(r.text)
        assert lang == langs[int(np.argmax(total))] and abs(score - 1 / np.exp(total - total.max()).sum()) < 1e-3


def test_backoff_takes_the_longest_known_grams():
    rows = np.log(np.array([[0.5, 0.1], [0.2, 0.3], [0.1, 0.6]], np.float32))
    model = langid.Model(["a", "b"], np.log([0.5, 0.5]), ["known"], np.zeros((1, 2), np.float32), ["b", "ab", "<ab"], rows)
    model._prepare()
    assert np.allclose(model.unseen("ab"), rows[2])  # "<ab" ends at b; no gram ends at a or ">"
    assert np.allclose(model.unseen("xab"), rows[1])
    assert np.allclose(model.unseen("zzb"), rows[0])
    assert np.allclose(model.unseen("q"), 0)


# ---------------------------------------------------------------- pseudo-likelihood

def _by_formula(model, text, counts, weights=None):
    """Log-probabilities of a text's words, one at a time."""
    w, v = weights or model.weights, model.vocabulary
    hashes, endings = WordHasher.get().words_and_endings(text)
    ranks = [v.hashes.tolist().index(h) if h in v.hashes else -1 for h in hashes.tolist()]
    rows = [r if 0 <= r < pseudo_lm.INPUT_WORDS else pseudo_lm.INPUT_WORDS + e % pseudo_lm.ENDINGS for r, e in zip(ranks, endings.tolist())]
    padded, out = [pseudo_lm.EDGE] * 2 + rows + [pseudo_lm.EDGE] * 2, []
    for k, (rank, ending, h) in enumerate(zip(ranks, endings.tolist(), hashes.view(np.int64).tolist())):
        of = rank if 0 <= rank < pseudo_lm.SINGLE else pseudo_lm.SINGLE + ending % (pseudo_lm.CLASSES - pseudo_lm.SINGLE)
        hidden = np.maximum(w["embed"][[padded[k], padded[k + 1], padded[k + 3], padded[k + 4]]].ravel() @ w["mid"] + w["mid_bias"], 0)
        top = (hidden @ w["top"] + w["top_bias"]).astype(float)
        low = (hidden @ w["low"][of // 16] + w["low_bias"][of // 16]).astype(float)
        share = np.log((counts.get(h, 0) + 0.5) / (v.mass[of] + 0.5 * (v.kinds[of] + 1)))
        out.append(top[of // 16] - np.log(np.exp(top).sum()) + low[of % 16] - np.log(np.exp(low).sum()) + share)
    return out


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    model = pseudo_lm.train(docs)
    return docs, model, {r.word: r.n for r in model.counts.collect()}, pseudo_lm.score(docs, model).collect()


def test_scores_equal_the_forward_formula(trained):
    docs, model, counts, rows = trained
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in sorted(rows, key=lambda r: r.n_words)[:400:16]:
        want = _by_formula(model, texts[r.doc_id], counts)
        assert r.n_words == len(want) and abs(r.log_prob - sum(want)) < 1e-3 * abs(sum(want)) + 1e-3


def test_rare_words_are_joined_with_their_counts(spark, trained):
    docs, model, counts, rows = trained
    few = dataclasses.replace(model, vocabulary=pseudo_lm.vocabulary_of(model.counts, known=300))
    assert 128 < len(few.vocabulary.hashes) <= 300
    part = docs.where("doc_id < 12").unionByName(spark.createDataFrame([(10**6, "neverseenword the xyzzyq neverseenword")], DOCS))
    got = {r.doc_id: r for r in pseudo_lm.score(part, few).collect()}
    for r in part.collect():
        want = _by_formula(few, r.text, counts)
        assert abs(got[r.doc_id].log_prob - sum(want)) < 1e-3 * abs(sum(want)) + 1e-3


def test_counts_are_exact_and_better_than_unigrams(trained):
    docs, model, counts, rows = trained
    want = {}
    for r in docs.collect():
        for h in WordHasher.get().words(r.text).view(np.int64).tolist():
            want[h] = want.get(h, 0) + 1
    assert counts == want
    v, total = model.vocabulary, sum(want.values())
    assert int(v.mass.sum()) == total and int(v.kinds.sum()) == len(want)
    unigram = sum(n * np.log((n + 0.5) / (total + 0.5 * (len(want) + 1))) for n in want.values())
    assert sum(r.log_prob for r in rows) > unigram + 0.3 * total


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(3)
    w = {k: rng.standard_normal(s) * 0.3 for k, s in pseudo_lm.SHAPES.items()}
    x, y = rng.integers(0, 40, (30, pseudo_lm.WIDTH)).astype(np.int16), rng.integers(0, pseudo_lm.CLASSES, 30).astype(np.uint8)

    def loss():
        h = np.maximum(w["embed"][x].reshape(len(y), -1) @ w["mid"] + w["mid_bias"], 0)
        top = h @ w["top"] + w["top_bias"]
        low = np.stack([a @ w["low"][c // 16] + w["low_bias"][c // 16] for a, c in zip(h, y)])
        at = np.arange(len(y))
        return -np.mean(top[at, y // 16] - np.log(np.exp(top).sum(1)) + low[at, y % 16] - np.log(np.exp(low).sum(1)))

    dense, rows, embed = pseudo_lm.gradients(w, x, y)
    full = np.zeros(pseudo_lm.SHAPES["embed"])
    full[rows] = embed
    for name, grad in (dense | {"embed": full}).items():
        flat = w[name].reshape(-1)
        for k in [*rng.integers(0, flat.size, 6), *np.argsort(-abs(grad).ravel())[:6]]:
            was = flat[k]
            flat[k] = was + 1e-5
            up = loss()
            flat[k] = was - 1e-5
            slope = (up - loss()) / 2e-5
            flat[k] = was
            assert abs(slope - grad.ravel()[k]) < 1e-6 + 1e-4 * abs(slope), (name, k)


def test_probabilities_sum_to_one(trained):
    _, model, counts, _ = trained
    v = model.vocabulary
    shares = np.zeros(pseudo_lm.CLASSES)
    rows = model.counts.collect()
    ranks = v.known(np.array([r.word for r in rows]).view(np.uint64))
    of = v.classes(ranks, np.array([r.ending for r in rows]))
    np.add.at(shares, of, (np.array([r.n for r in rows]) + 0.5) / np.exp(v.log_total())[of])
    unseen = 0.5 / np.exp(v.log_total())
    assert np.allclose(shares + unseen, 1)
    h = np.abs(np.random.default_rng(0).standard_normal((5, pseudo_lm.HIDDEN)))
    scorer = pseudo_lm.Scorer(model.weights)
    total = 0
    for c in range(pseudo_lm.CLASSES):
        top = scorer._own(h @ model.weights["top"] + model.weights["top_bias"], np.full(5, c // 16))
        total = total + np.exp(top + scorer._own(h @ model.weights["low"][c // 16] + model.weights["low_bias"][c // 16], np.full(5, c % 16)))
    assert np.allclose(total, 1, atol=1e-5)


def test_default_training_reads_every_word(spark):
    cycle = ["one", "two", "three", "four", "five", "six", "seven", "eight"]  # a stride of 8 or 16 meets one of them
    docs = spark.createDataFrame([(1, " ".join(cycle * 4000))], DOCS)
    (row,) = pseudo_lm.score(docs, pseudo_lm.train(docs)).collect()
    assert row.mean_log_prob > -0.5
    defaults = {k: p.default for k, p in inspect.signature(pseudo_lm.train).parameters.items()}
    assert defaults["stride"] <= defaults["rounds"]


def test_documents_that_occur_twice_score_higher(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(60))
    once, twice = [text() for _ in range(30)], [text() for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(once + twice + twice)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = {r.doc_id: r.mean_log_prob for r in pseudo_lm.score(docs, pseudo_lm.train(docs)).collect()}
    assert min(found[k] for k in range(30, 90)) > max(found[k] for k in range(30))


def test_weights_of_many_tasks_are_added_level_by_level(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"some words {k} to learn from {k % 3}") for k in range(60)], DOCS).repartition(13)
    vocabulary = pseudo_lm.vocabulary_of(pseudo_lm.count_words(docs))
    start = pseudo_lm.start_weights(vocabulary)
    rows = pseudo_lm.numbered(docs, vocabulary)
    assert rows.rdd.getNumPartitions() == 13
    once = pseudo_lm.train_round(rows, start, 1, 0, 0.1, 64)
    monkeypatch.setattr(pseudo_lm, "FAN", 3)
    again = pseudo_lm.train_round(rows, start, 1, 0, 0.1, 64)
    assert all(np.allclose(once[k], again[k], atol=1e-6) for k in once)


def test_awkward_texts_are_scored(spark):
    docs = docs_df(spark, AWKWARD + [(10, "some words to learn from")], EXTRA + ["word", "times"])
    rows = {r.doc_id: r for r in pseudo_lm.score(docs, pseudo_lm.train(docs)).collect()}
    assert all((rows[k].n_words, rows[k].log_prob, rows[k].mean_log_prob) == (0, 0.0, None) for k in (1, 2, 3, 4))
    assert rows[8].n_words == 30_001 and rows[10].mean_log_prob < 0
    empty = spark.createDataFrame([], DOCS)
    assert pseudo_lm.score(empty, pseudo_lm.train(empty)).collect() == []


# ---------------------------------------------------------------- fingerprints

RNG = random.Random(6)


def _text(n):
    return "".join(RNG.choices("abcdefg hé", k=n))


def test_syncmers_equal_brute_force():
    text = _text(3000)
    codes = np.array([ord(c) for c in text], np.uint32)
    small = syncmers._mix(syncmers._runs(codes.astype(np.uint64) + np.uint64(1), 1, syncmers.S)) >> np.uint64(32)
    inner = syncmers.K - syncmers.S
    want = [k for k in range(len(text) - syncmers.K + 1) if min(small[k:k + inner + 1]) in (small[k], small[k + inner])]
    hashes, at = syncmers.syncmers(codes)
    assert at.tolist() == want
    assert len({text[k:k + syncmers.K] for k in want}) == len(set(hashes.tolist()))
    moved, moved_at = syncmers.syncmers(np.concatenate([codes[:500], codes[:0], np.full(37, 120, np.uint32), codes[500:]]))
    assert set(moved[moved_at >= 537].tolist()) == set(hashes[at >= 500].tolist())  # free of context
    assert max(np.diff(at)) <= inner + 1  # a window guarantee


def test_likeness():
    text = _text(4000)
    a = syncmers.anchors(text)
    assert syncmers.likeness(a, a) == 1.0 and len(a) == len(syncmers.syncmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))[0])
    assert syncmers.likeness(a, syncmers.anchors(_text(4000))) == 0.0
    near = syncmers.likeness(a, syncmers.anchors(text[:2000] + "inserted" + text[2000:]))
    assert 0.8 < near < 1.0 or near == 1.0
    swapped = syncmers.likeness(a, syncmers.anchors(text[2000:] + text[:2000]))
    assert swapped < 0.75  # the anchors are there, but not in order
    none = syncmers.anchors("")
    assert syncmers.likeness(none, none) == 1.0 and syncmers.likeness(none, a) == 0.0
    assert np.array_equal(syncmers.from_text(syncmers.to_text(a)), a)


def test_repeated_anchors_match_at_every_place():
    text = "abcdefghijklmnopqrstuvwxyz0123456789 " * 400 + _text(600)
    assert len(syncmers.anchors(text)) == len(syncmers.syncmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))[0])
    x, y = _text(900), _text(700)
    inside, whole = syncmers.anchors(y + x), syncmers.anchors(x + y + x)
    assert abs(syncmers.likeness(inside, whole) - len(inside) / len(whole)) < 0.03  # YX lies whole inside XYX
    assert syncmers.likeness(syncmers.anchors("long " * 20_000), syncmers.anchors("long " * 10_000)) == pytest.approx(0.5, abs=0.01)


def test_likeness_equals_brute_force():
    rng = random.Random(2)
    for kinds in (3, 8, 1000):
        for _ in range(60):
            a, b = ([rng.randrange(kinds) for _ in range(rng.randrange(1, 25))] for _ in range(2))
            table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, v in enumerate(a):
                for j, w in enumerate(b):
                    table[i + 1][j + 1] = table[i][j] + 1 if v == w else max(table[i][j + 1], table[i + 1][j])
            union = sum(max(a.count(v), b.count(v)) for v in {*a, *b})
            rows = [np.stack([np.array(v), np.arange(len(v)) * 5], axis=1).astype("<u4") for v in (a, b)]
            assert syncmers.likeness(*rows) == table[-1][-1] / union


def test_rows_follow_each_other_over_all_blocks(spark):
    rows = [(k * 3, _text(RNG.randint(0, 200))) for k in range(150)] + AWKWARD + [(None, "another without id")]
    for blocks in (1, 7, 64):
        got = syncmers.fingerprints(docs_df(spark, rows, EXTRA), blocks).collect()
        ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        want = []
        for k, (doc_id, text) in enumerate(ordered):
            following = ordered[(k + 1) % len(ordered)][1]
            changed = syncmers.edited(text, following)
            a, b, c = (syncmers.anchors(t) for t in (text, changed, following))
            want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), syncmers.to_text(a), syncmers.to_text(b),
                         syncmers.likeness(a, b), syncmers.likeness(a, c)))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    one = syncmers.fingerprints(docs_df(spark, [(1, "only this text, long enough for an anchor")])).collect()
    assert [(r.near_next, r.near_edited < 1) for r in one] == [(1.0, True)]
    assert syncmers.fingerprints(spark.createDataFrame([], DOCS)).collect() == []


def test_fingerprints_keep_every_anchor(spark):
    rng = random.Random(16)
    passage, *long = ("".join(rng.choices("abcdefg hé", k=n)) for n in (300, 40_000, 30_000))
    first, second = (t[:9_000] + passage + t[9_000:] for t in long)
    rows = {r.doc_id: r for r in syncmers.fingerprints(docs_df(spark, [(2, first), (1, second)]), 1).collect()}
    for doc_id, text in ((2, first), (1, second)):
        hashes, at = syncmers.syncmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        found = syncmers.from_text(rows[doc_id].fingerprint)
        assert len(found) > 3_000 and found.tolist() == np.stack([hashes, at], 1).tolist()
    inside = len(syncmers.syncmers(np.frombuffer(passage.encode("utf-32-le"), "<u4"))[0])
    union = len(np.union1d(*(syncmers.from_text(rows[k].fingerprint)[:, 0] for k in (1, 2))))
    assert inside > 20 and inside <= rows[2].near_next * union + 5 < inside + 20


def test_numerals_are_no_letters(spark):
    docs = docs_df(spark, [(1, "½ ² ¾"), (2, "Ⅷ ① 三"), (3, "the x² house")])
    model = langid.learn(spark.createDataFrame([("the house of the river", "en")] * 3, "text string, lang string"))
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert got == {1: "und", 2: "en", 3: "en"} and langid.words_of("Ⅷ ① 三 x²y") == ["三", "x", "y"]
    for c in map(chr, range(0x3000)):
        if len(c.lower()) == 1:
            assert langid.words_of(c) == ([c.lower()] if c.isalpha() else []), hex(ord(c))


def test_null_doc_ids_are_in_no_fold(spark):
    df = docs_df(spark, [(None, "x"), (3, "y")])
    assert langid.learned_from(df).where(F.col("doc_id").isNull()).count() == 0


def test_softmaxes_of_all_rows_match_those_of_each():
    """Rows of any magnitude, groups that don't occur, and scoring in one call for a chunk instead of one for each row or group."""
    from unittest import mock

    from knnspark.llm import pseudo_lm as lm

    rng = np.random.default_rng(6)
    logits = (rng.standard_normal((300, lm.GROUP)) * rng.choice([1, 30, 1e4], (300, 1))).astype(np.float32)
    true = np.exp(logits.astype(float) - logits.max(axis=1, keepdims=True))
    true /= true.sum(axis=1, keepdims=True)
    assert np.allclose(lm._softmax(logits.copy()), true, atol=1e-6)
    of = rng.integers(0, lm.GROUP, 300)
    with np.errstate(divide="ignore"):
        want = np.log(true[np.arange(300), of])
    assert np.allclose(np.maximum(lm.Scorer._own(logits.copy(), of), -80), np.maximum(want, -80), atol=1e-4)
    weights = {k: rng.standard_normal(s).astype(np.float32) for k, s in lm.SHAPES.items()}
    texts = [rng.integers(0, lm.INPUTS, n).astype(np.int16) for n in (5, 0, 40)]
    classes = rng.choice([0, 1, 17, 200], 45).astype(np.uint8)  # four of the groups
    with mock.patch.object(lm.Scorer, "_own", side_effect=lm.Scorer._own) as own:
        found = lm.Scorer(weights).log_probs(texts, classes)
    assert own.call_count == 2  # groups, and the classes of all groups
    rows, at = lm.windows(texts)
    for k, (place, c) in enumerate(zip(at, classes)):
        h = np.maximum(weights["embed"][rows[place + lm._OFFSETS]].reshape(-1) @ weights["mid"] + weights["mid_bias"], 0).astype(float)
        log_softmax = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
        g, o = divmod(int(c), lm.GROUP)
        assert abs(log_softmax(h @ weights["top"] + weights["top_bias"])[g] + log_softmax(h @ weights["low"][g] + weights["low_bias"][g])[o] - found[k]) < 1e-3
