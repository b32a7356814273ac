import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import langid
from marketlake.llm.text import remainder


def cost(scores, path, penalty):
    return sum(scores[i, l] for i, l in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_finds_the_best_path():
    random = np.random.default_rng(7)
    tables = [random.normal(size=(n, 3)) * 3 for n in (1, 2, 5, 6, 6, 3)]
    for scores, path in zip(tables, langid.viterbi(tables, 2.0)):
        best = max(cost(scores, p, 2.0) for p in itertools.product(range(3), repeat=len(scores)))
        assert cost(scores, path, 2.0) == pytest.approx(best)


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(langid.sample(documents, remainder(F.col("doc_id"), 3) != 1))


def test_one_language_is_only_assumed_where_the_path_agrees(documents, model):
    labeler = langid.Labeler(model)
    for text in [r["text"] for r in documents.limit(80).collect()]:
        words, scores, spoken, labels = labeler.read(text)
        if labels is not None and len(scores):
            assert (langid.viterbi([scores], labeler.penalty)[0] == labels).all()


def test_held_out_documents(documents, model):
    found = langid.identified(documents, model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_spans_of_mixed_text(documents, model, make):
    texts = {lang: documents.filter(F.col("lang") == lang).filter("n_chars > 600").first()["text"] for lang in ("en", "fr")}
    english, french = [" ".join(texts[lang].split()[:80]) for lang in ("en", "fr")]
    row = langid.identified(make((1, f"{english} 12 {french}")), model).first()
    spans = [(s["lang"], s["length"]) for s in row["spans"]]
    assert [lang for lang, _ in spans] == ["en", "fr"]
    assert abs(spans[0][1] - 81) <= 4 and sum(n for _, n in spans) == 161


def test_texts_without_letters(make, model, rows):
    docs = make((1, None), (2, ""), (3, "12 .. 3\n"), (None, "the of and"), (4, "the of and"), (4, "the of and"))
    found = rows(langid.identified(docs, model), "doc_id", "lang_pred", "score")
    assert found == [(None, "en", 1.0), (1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0), (4, "en", 1.0)]
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "4", "None"]


def test_scripts_narrow_the_languages(make):
    rows = [(1, "привет мир слово дело", "ru"), (2, "hello world word deed", "en"), (3, "γεια σου κοσμε", "el")]
    model = langid.fit(langid.sample(make(*rows), F.lit(True)))
    found = langid.identified(make((1, "жжж щщщ"), (2, "qqq zzz"), (3, "ξξξ ψψψ"), (4, "漢字")), model)
    assert [r["lang_pred"] for r in sorted(found.collect(), key=lambda r: r["doc_id"])][:3] == ["ru", "en", "el"]


def test_scripts_of_no_language_are_held_by_none(make, documents, model):
    known = documents.filter("lang = 'fr' and n_chars > 600").first()["text"]
    letters = sum(map(str.isalpha, known.lower()))
    docs = make((1, "привет мир слово дело"), (2, "漢字 仮名"), (3, f"{known} {'ж' * letters}"), (4, f"{known} {'ж' * (3 * letters)}"), (5, known))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identified(docs, model).collect()}
    assert found[1] == found[2] == (model.languages[model.commonest], 0.0)
    alone = found[5][1]
    assert alone > 0.9
    assert found[3] == ("fr", pytest.approx(alone / 2)) and found[4] == ("fr", pytest.approx(alone / 4))
    assert sorted(r["doc_id"] for r in langid.accepted(docs, model).collect()) == [3, 5]


def test_words_may_be_forgotten(documents, model, monkeypatch):
    texts = [r["text"] for r in documents.limit(30).collect()]
    whole = langid.Labeler(model).texts(texts)
    monkeypatch.setattr(langid, "REMEMBERED_WORDS", 50)
    assert langid.Labeler(model).texts(texts) == whole


def test_no_language_is_left_out(make, monkeypatch):
    docs = make((1, "some text", "en"), (2, "other text", "en"), (3, "du texte", "fr"))
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    assert langid.fit(langid.sample(docs, F.lit(True))).languages == ("en", "fr")
    monkeypatch.setattr(langid, "LANGUAGES", 1)
    with pytest.raises(ValueError, match="2 languages"):
        langid.sample(docs, F.lit(True))


def test_nothing_learned(make):
    docs = make((1, "some text"), (2, None, "en"))
    model = langid.fit(langid.sample(docs, F.lit(True)))
    assert [(r["lang_pred"], r["score"]) for r in langid.identified(docs, model).collect()] == [("und", 0.0)] * 2
    assert langid.identified(docs.limit(0), model).count() == 0


def test_the_sample_is_bounded_and_knows_null_ids(make):
    text = "mot de la langue nulle"
    rows = [(None, f"{text} {i}", "fr") for i in range(30)] + [(5, "same words of one id", "en")] * 50
    found = langid.sample(make(*rows), F.lit(True), rows=10).collect()
    assert sorted(r["lang"] for r in found) == ["en"] + ["fr"] * 10
    model = langid.fit(langid.sample(make(*rows), F.lit(True)))
    assert model.languages == ("en", "fr")


def test_the_sample_is_that_of_the_smallest_hashes(spark, make):
    docs = make(*[(i, f"text {i}", "en" if i % 3 else "fr") for i in range(6000)])
    turn = F.xxhash64(F.col("doc_id").cast("string"), "text")
    hashes = {}
    for r in docs.select("lang", "text", turn.alias("turn")).collect():
        hashes.setdefault(r["lang"], []).append((r["turn"], r["text"]))
    for limit in (5, 1500):
        expected = sorted((lang, text) for lang, of in hashes.items() for _, text in sorted(of)[:limit])
        found = langid.sample(docs, F.lit(True), rows=limit).collect()
        assert sorted((r["lang"], r["text"]) for r in found) == expected


def plain_label(model, text, penalty):
    """Language and score by a plain Viterbi over words, one after the other."""
    n = len(model.languages)
    cells, sizes, held = [], [], []
    for word in text.lower().split():
        letters = "".join(filter(str.isalpha, word))
        if not letters:
            continue
        sizes.append(len(letters))
        used = [all(model.scripts[langid.script_of(c), l] for c in letters) for l in range(n)]
        score = model.logs[langid.trigram_buckets([letters])[0]].sum(axis=0).astype(np.float32).astype(float)
        held.append(len(letters) if any(used) else 0)
        if not any(used):
            score = np.zeros(n)
        elif not all(used):
            low = min(s for s, u in zip(score, used) if u) - 2 * penalty
            score = np.array([s if u else low for s, u in zip(score, used)])
        cells.append(score)
    if not cells:
        return "und", 0.0
    total, back = list(cells[0]), []
    for score in cells[1:]:
        top = int(np.argmax(total))
        step = [l if total[l] >= total[top] - penalty else top for l in range(n)]
        total = [max(total[l], total[top] - penalty) + score[l] for l in range(n)]
        back.append(step)
    label = int(np.argmax(total))
    path = [label]
    for step in reversed(back):
        label = step[label]
        path.append(label)
    path.reverse()
    letters = np.bincount(path, weights=held, minlength=n)
    best = int(letters.argmax()) if sum(held) else model.commonest
    return model.languages[best], letters[best] / sum(sizes)


def test_labels_against_a_plain_search(documents, model, make):
    mixed = [r["text"] for r in documents.filter("n_chars > 300").limit(12).collect()]
    texts = [r["text"] for r in documents.limit(60).collect()]
    texts += [" ".join(x for pair in zip(mixed[i].split(" ")[:40], mixed[i + 1].split(" ")[:40]) for x in pair) for i in range(10)]
    texts += [" ".join(mixed[i].split()[:60] + mixed[i + 2].split()[:60]) for i in range(8)]
    texts += ["mot 漢字 word", "漢字", "", "12 34", " ".join(mixed) * 20]
    found = {r["doc_id"]: r for r in langid.identified(make(*enumerate(texts)), model).collect()}
    for i, text in enumerate(texts):
        lang, score = plain_label(model, text, langid.SWITCH_PENALTY)
        assert (found[i]["lang_pred"], found[i]["score"]) == (lang, pytest.approx(score, abs=1e-3)), i
