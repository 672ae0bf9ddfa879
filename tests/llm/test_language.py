import numpy as np

from tidemark.llm import language

DOCS = "doc_id long, text string, lang string"
PAGES = "page_id long, url string, html string, lang string, host int"
ENGLISH = "the weather in the north was cold and the rivers were high with rain "
GERMAN = "das wetter im norden war kalt und die flüsse waren hoch vom vielen regen "


def corpus(spark):
    rows = [(i, ENGLISH * 3, "en") for i in range(6)] + [(10 + i, GERMAN * 3, "de") for i in range(6)]
    return spark.createDataFrame(rows + [(30, None, "en"), (31, "x", None), (None, GERMAN, "de")], DOCS)


def page(page_id, url, lang, text):
    declared = f' lang="{lang}"' if lang else ""
    return (page_id, url, f"<html{declared}><style>p{{}}</style><p>{text}</p><script>the the</script>", "zz", 0)


def test_evidence_is_fused(spark):
    languages, table = language.train(corpus(spark))
    assert languages == ["de", "en"]
    rows = [page(i, f"https://a.beispiel.de/{i}", "de", GERMAN * 4) for i in range(12)]
    rows += [page(20 + i, f"http://www.sample.com/{i}", "en", ENGLISH * 4) for i in range(12)]
    rows += [
        page(40, "https://a.beispiel.de/x", None, ""),
        page(41, "http://sample.com/y", None, ""),
        page(42, "https://neu.beispiel.de/z", "de-AT", "12 34"),
        page(43, None, None, ENGLISH),
        (44, "not an address", None, None, 1),
        (None, "https://a.beispiel.de/x", None, None, 1),
        page(45, "http://sample.com/y", "xx", ENGLISH),
    ]
    rows.append(rows[0])
    found = language.identify(spark.createDataFrame(rows, PAGES), languages, table).collect()
    assert len(found) == len(rows)
    answer = {r.page_id: r for r in found}
    assert all(answer[i].lang == "de" for i in [*range(12), 40, 42, None])
    assert all(answer[20 + i].lang == "en" for i in range(12))
    assert answer[41].lang == "en" and answer[43].lang == "en" and answer[45].lang == "en"
    assert answer[45].declared == "other" and answer[44].declared == "none" and answer[44].host is None
    assert answer[20].host == "sample.com"
    assert all(0.5 <= r.probability <= 1.0 for r in found)


def test_declarations_do_not_outvote_clear_text(spark):
    languages, table = language.train(corpus(spark))
    rows = [page(i, f"http://h{i}.org/", "en", ENGLISH * 4) for i in range(10)]
    rows += [page(20 + i, f"http://g{i}.org/", "de", GERMAN * 4) for i in range(10)]
    rows += [page(50, "http://z.org/", "en", GERMAN * 20)]
    found = {r.page_id: r for r in language.identify(spark.createDataFrame(rows, PAGES), languages, table).collect()}
    assert found[50].lang == "de" and found[50].declared == "en"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    languages, table = language.train(empty)
    assert languages == []
    pages = spark.createDataFrame([page(1, "http://a.org", "en", "x")], PAGES)
    assert language.identify(pages, languages, table).first().lang is None
    languages, table = language.train(corpus(spark))
    assert language.identify(pages.limit(0), languages, table).count() == 0


def test_visible_text_and_trigrams():
    assert language.visible_text("<p>a&amp;b</p><!-- c --><script>d</script>").split() == ["a&b"]
    assert language.visible_text(None) == ""
    assert len(language.trigrams("")) == 0 and len(language.trigrams(None)) == 0
    assert (language.trigrams("Abc") == language.trigrams("abc")).all()
    assert np.array_equal(language.trigrams("ab1cd"), language.trigrams("ab cd"))
