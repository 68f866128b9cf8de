import zlib

from cityflow.llm import langid
from cityflow.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


def test_held_out_accuracy(spark, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = QUERIES["op9_language_id"](spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    own = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang_pred == lang[r.doc_id] for r in own) >= 0.97 * len(own)


def test_family_first_then_pairs(documents):
    model = langid.fit(documents)
    assert model.families == ["germanic", "romance"]
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert sorted(model.pairs) == [("de", "en"), ("es", "fr")]


def test_odd_rows(docs, documents):
    rows = [*ODD, (30, "12 34 !? 5_6")]
    frame = docs(rows)
    got = langid.predict(frame, langid.fit(documents)).collect()
    assert len(got) == len(rows)
    texts = dict(rows[:4] + rows[-1:])
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3, 30)), texts
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (4, 5, 8))
    assert langid.predict(docs([]), langid.fit(documents)).collect() == []


def test_poor_labels(spark, docs):
    none = spark.createDataFrame([(1, "a", None)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in langid.predict(docs(ODD), langid.fit(none)).collect()} == {"und"}
    one = spark.createDataFrame([(1, "a b", "xx"), (1, "a b", "xx")], none.schema)
    got = langid.predict(docs([(1, "words"), (2, None)]), langid.fit(one)).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == [(1, "xx"), (2, "und")]


def test_training_rows_are_bounded(spark, monkeypatch):
    """Repeated ids count once, and many labels share what one may have in all."""
    seen = []
    features = langid.features
    monkeypatch.setattr(langid, "svm", lambda x, y: seen.append(len(y)) or features("a b"))
    rows = [(1, f"word {k}", "xx") for k in range(50)] + [(k, f"word {k}", "yy") for k in range(2, 7)]
    schema = "doc_id bigint, text string, lang string"
    langid.fit(spark.createDataFrame(rows, schema))
    assert max(seen) == 6
    monkeypatch.setattr(langid, "TRAIN_ROWS", 8)
    seen.clear()
    rows = [(k, f"word {k}", f"l{k % 4}") for k in range(100)] + [(200 + k, "x", f"n{k:02d}") for k in range(20)]
    model = langid.fit(spark.createDataFrame(rows, schema))
    assert max(seen) == 8 and len(model.languages) == 8
    assert {"l0", "l1", "l2", "l3"} <= {x for own in model.languages.values() for x in own}
