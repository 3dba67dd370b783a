import corpus_pipeline
from tests.llm import cases

LONG = " ".join(f"word{k}" for k in range(80))
NEAR = LONG.replace("word40", "changed")
OTHER = " ".join(f"other{k}" for k in range(80))


def test_texts_under_one_id_and_without_id_are_judged_by_their_text(spark):
    rows = [(i, t, "en", "a", 0) for i, t in [
        (1, LONG), (2, NEAR), (3, OTHER), (3, "a text of its own under the id of another one, to stay"), (3, LONG), (4, OTHER), (4, OTHER),
        (None, LONG), (None, "nobody's own words stay, once"), (None, "nobody's own words stay, once"), (5, None), (6, ""), (None, None)]]
    docs = cases.clashing(cases.frame(spark, rows), "key", "shared", "Row")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    texts = sorted((r.text or "") for r in out.collect())
    group = [t for t in texts if t in (LONG, NEAR)]
    assert len(group) == 1 and texts.count(OTHER) == 1
    assert texts.count("a text of its own under the id of another one, to stay") == 1 and texts.count("nobody's own words stay, once") == 1
    assert texts.count("") == 3


def test_the_smallest_of_ordinary_ids_stays(spark):
    rows = [(i, t, "en", "a", 0) for i, t in [(9, LONG), (4, NEAR), (7, LONG), (2, OTHER)]]
    out = corpus_pipeline.near_duplicates(spark, cases.frame(spark, rows), "")
    assert sorted(r.doc_id for r in out.collect()) == [2, 4]
