from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import CLASHING
from ticketlake.llm import language

PARTS = {"xx": ("ka", "lo", "mit", "ren"), "yy": ("shu", "pra", "lo", "vix"), "zz": ("ö", "nje", "gra", "éch")}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randrange(1, 4))) for _ in range(n)) + "."


def corpus(seed, n):
    rng = random.Random(seed)
    return [(i, text(rng, lang, rng.randrange(3, 40)), lang) for i in range(n) for lang in [rng.choice(list(PARTS))]]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for _, t, lang in corpus(1, 200)] + [("unlabelled kakaka", None), (None, "xx"), ("12 34", "yy")]
    return language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))


def test_held_out_texts_are_recognised(spark, model):
    rows = corpus(2, 300)
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in language.predict(table, model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows]) > 0.97
    assert all(0 < got[i]["score"] <= 1 for i, _, _ in rows)


def test_known_words_come_first_and_unseen_ones_back_off(model):
    lo = model.units[0]["lo"]
    assert model.logs[0][lo][0] > model.logs[0][lo][2]  # a word of xx and yy, not of zz
    assert all(w not in model.units[0] for w in ("kalomitrenka", "k", "qqq"))
    grams = [model.units[4][g] for g in language.grams("kalomitrenka", 4) if g in model.units[4]]
    want = model.logs[4][grams].mean(0) + language.STEP_COST
    assert np.allclose(model.unseen(["kalomitrenka"])[0], want)
    # only single characters are known: three steps down
    only = [model.units[1][g] for g in "öö" if g in model.units[1]]
    short = language.Model(model.langs, model.prior, [{}, model.units[1], {}, {}, {}], model.logs)
    assert np.allclose(short.unseen(["öö"])[0], model.logs[1][only].mean(0) + 4 * language.STEP_COST)
    assert (model.unseen(["中"]) == 0).all()


def test_counts_cover_all_rows(model):
    counts = {}
    for _, t, lang in corpus(1, 200):
        for word in language.words(t):
            counts.setdefault(word, dict.fromkeys(model.langs, 0))[lang] += 1
    totals = np.array([sum(c[lang] for c in counts.values()) for lang in model.langs])
    for word, row in model.units[0].items():
        n = np.array([counts[word][lang] for lang in model.langs])
        share = (n + language.SMOOTHING) / (totals + language.SMOOTHING * len(model.units[0]))
        assert np.allclose(model.logs[0][row], np.log(share))


def test_the_model_is_bounded_and_keeps_the_most_frequent(spark):
    rows = [(f"w{i}", "xx", 1) for i in range(400)] + [(f"f{i}", "xx", 40 + i) for i in range(30)]
    rows += [("f0", "yy", 2)]
    counts = spark.createDataFrame(rows, "unit string, lang string, n bigint").repartition(3)
    counts = language._by_unit(counts, ["xx", "yy"])
    kept = {r["unit"]: r["counts"] for r in language._most_frequent(counts, 130)}
    assert {f"f{i}" for i in range(30)} <= kept.keys() and kept["f0"] == "0:40,1:2"
    assert 100 <= len(kept) <= 160
    assert len(language._most_frequent(counts, 1000)) == 430


def test_odd_rows_empty_tables_and_no_languages(spark, docs, odd_rows, empty, model):
    found = language.predict(docs(odd_rows), model)
    assert found.columns == ["doc_id", "text", *(c for c in CLASHING if c != "score"), "lang_pred", "score"]
    for r in found.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert r["lang_pred"] in {"und", *PARTS} and 0 <= r["score"] <= 1
    assert language.predict(empty, model).count() == 0
    nothing = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert {(r["lang_pred"], r["score"]) for r in language.predict(docs(odd_rows), nothing).collect()} == {("und", 0.0)}


def test_units_that_no_task_holds_count_as_well(spark, monkeypatch, docs, model):
    """Nearly all words and n-grams are looked up; every score stays as if all were held."""
    monkeypatch.setattr(language, "MAX_WORDS", 4)
    monkeypatch.setattr(language, "MAX_GRAMS", 3)
    rows = [(t, lang) for _, t, lang in corpus(1, 200)]
    few = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert all(len(few.units[n]) < len(model.units[n]) for n in (0, 2, 3, 4))
    table = docs([(i, t) for i, t, _ in corpus(2, 60)] + [(900, "kalomitrenka öö 中 qqq"), (901, None), (901, None)])
    got, want = (sorted((r[0], r["lang_pred"], r["score"]) for r in language.predict(table, m).collect()) for m in (few, model))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-9, atol=0)


def plain_predictions(taught, texts):
    """Every word and n-gram counted in plain dictionaries, every text scored word by word."""
    def letters(t):
        return "".join(c if unicodedata.category(c).startswith("L") else " " for c in (t or "").lower()).split()

    def pieces(word, n):
        padded = word if n <= 1 else f"<{word}>"
        return [padded[i : i + n] for i in range(len(padded) - n + 1)]

    langs = sorted({lang for t, lang in taught if lang is not None and letters(t)})
    counts = [defaultdict(Counter) for _ in range(5)]
    for t, lang in taught:
        for word in letters(t) if lang is not None else ():
            counts[0][word][lang] += 1
            for n in range(1, 5):
                for piece in pieces(word, n):
                    counts[n][piece][lang] += 1
    whole = [{lang: sum(c[lang] for c in by.values()) for lang in langs} for by in counts]

    def log(n, unit, lang):
        return math.log((counts[n][unit][lang] + 0.1) / (whole[n][lang] + 0.1 * len(counts[n])))

    def word_score(word, lang):
        if word in counts[0]:
            return log(0, word, lang)
        for n in range(4, 0, -1):
            known = [log(n, p, lang) for p in pieces(word, n) if p in counts[n]]
            if known:
                return sum(known) / len(known) + math.log(0.4) * (5 - n)
        return 0.0

    out = []
    for t in texts:
        total = {lang: math.log(whole[0][lang] / sum(whole[0].values())) + sum(word_score(w, lang) for w in letters(t)) for lang in langs}
        best = max(total.values()) if letters(t) else None
        share = best is not None and 1 / sum(math.exp(v - best) for v in total.values())
        out.append((next(x for x in langs if total[x] == best), share) if share else ("und", 0.0))
    return out


@pytest.mark.parametrize("held", [(language.MAX_WORDS, language.MAX_GRAMS), (5, 3)])
def test_whole_predictions_equal_plain_counting(spark, monkeypatch, docs, odd_rows, held):
    monkeypatch.setattr(language, "MAX_WORDS", held[0])
    monkeypatch.setattr(language, "MAX_GRAMS", held[1])
    taught = [(t, lang) for _, t, lang in corpus(5, 120)] + [(None, "xx"), ("no lang", None), ("12 ½", "nil"), ("Straße ② Ⅳ", "xx")]
    taught += [t for t in taught[:9] for _ in range(4)]
    fitted = language.fit(spark.createDataFrame(taught, "text string, lang string").repartition(4))
    rows = [(i, t) for i, t, _ in corpus(6, 80)] + odd_rows
    rows += [(700, "½ ②"), (701, "Ⅳ"), (702, "٣"), (703, "ªº"), (704, "kaŉ ʰ a_b c1d"), (705, "zzzz qqqq"), (706, "ka " * 30_000)]
    got = sorted(((r["doc_id"], r["text"]), r["lang_pred"], r["score"]) for r in language.predict(docs(rows).where("doc_id is not null"), fitted).collect() if r["text"] is not None)
    rows = sorted(r for r in rows if None not in r)
    for (key, lang, score), row, (want, share) in zip(got, rows, plain_predictions(taught, [t for _, t in rows]), strict=True):
        assert key == row and lang == want and score == pytest.approx(share, rel=1e-6)


def test_columns_of_any_name_stay(spark, model):
    names = ["predicted_lang", "predicted_score", "digest_to_read", "digest", "found", "block", "part", "unit", "a.b", "lang", "total"]
    table = spark.createDataFrame([(1, "kalomit", *names), (2, None, *names)], ", ".join(["doc_id bigint", "text string", *(f"`{n}` string" for n in names)]))
    got = language.predict(table, model)
    assert got.columns == [*table.columns, "lang_pred", "score"]
    assert all(list(r)[2:-2] == names for r in got.collect())
    assert sorted(r["lang_pred"] for r in got.collect()) == ["und", "xx"]
