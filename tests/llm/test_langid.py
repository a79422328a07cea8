from pyspark.sql import functions as F
from tables import documents, none

from farelake.llm import langid
from farelake.llm.registry import op5_language_id

SAMPLES = {"de": "der hund und die katze schlafen nicht im garten", "en": "the dog and the cat do not sleep in the garden",
           "fr": "le chien et le chat ne dorment pas dans le jardin"}


def model_of(spark, **settings):
    rows = [(n * 10 + at, text, lang) for at, (lang, text) in enumerate(SAMPLES.items()) for n in range(5)]
    rows += [(900, "ignored words", None), (901, None, "en"), (None, SAMPLES["en"], "en"), (902, "", "en")]
    return langid.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), **settings)


def test_known_words_then_shorter_n_grams(spark):
    model = model_of(spark)
    assert model.languages == ["de", "en", "fr"]
    for lang, text in SAMPLES.items():
        assert model.predict(text)[0] == lang and model.predict(text.upper())[1] > 0.9
    assert "katze" in model.words and "katzes" not in model.words
    # "^kat" is the longest known part of an unseen word; "zzq" falls back to single letters.
    assert model.predict("katzes")[0] == "de"
    row = model.of_unseen("zzq")
    assert (row == (model.grams["z"] if "q" not in model.grams else (2 * model.grams["z"] + model.grams["q"]) / 3)).all()
    assert model.of_unseen("漢字") is None


def test_undetermined(spark):
    model = model_of(spark)
    for text in (None, "", " \n", "123 ²³ ###", "🙂"):
        assert model.predict(text) == ("und", 0.0)
    lang, score = model.predict("漢字")  # letters that no language has: all are equally likely
    assert lang == "de" and abs(score - 1 / 3) < 1e-9


def test_awkward_rows(spark):
    docs = documents(spark).withColumns({"word": F.lit("own"), "entry": F.lit(1)})
    out = langid.predict_languages(docs, model_of(spark))
    assert out.columns == [*docs.columns, "lang_pred", "score"] and out.count() == docs.count()
    rows = out.collect()
    assert {row["lang_pred"] for row in rows if row["doc_id"] in (30, 31, 32, 33)} == {"und"}
    assert len({(row["lang_pred"], row["score"]) for row in rows if row["doc_id"] in (3, 20, 21)}) == 1
    nothing = langid.fit_languages(none(spark))
    assert {row["lang_pred"] for row in langid.predict_languages(docs, nothing).collect()} == {"und"}
    assert langid.predict_languages(none(spark), nothing).count() == 0


def test_model_size_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "WORDS", 4)
    model = model_of(spark)
    assert len(model.words) <= 4 * len(model.languages)


def test_equal_counts_fill_the_tables(spark, monkeypatch):
    """600 words of one count each: the first 100 of them are learned, not none."""
    monkeypatch.setattr(langid, "WORDS", 100)
    words = [f"{a}{b}{c}{d}" for a in "bdfgk" for b in "aeiou" for c in "lmnprstvwxyz" for d in "ao"]
    docs = spark.createDataFrame([(n, " ".join(words[at:at + 50]), "xx") for n, at in enumerate(range(0, 600, 50))], "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert sorted(model.words) == sorted(words)[:100]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = op5_language_id(spark, folder).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 0
