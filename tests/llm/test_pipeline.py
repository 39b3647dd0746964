import corpus_pipeline
from ordstrata.llm.common import read_table


def test_stages(spark, sf_dir):
    docs = columns = read_table(spark, sf_dir, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns.columns, name
        docs = docs.cache()
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > counts[0] / 2
    assert docs.filter("text RLIKE '[a-z]@[a-z]'").isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == counts[-1]
    again = corpus_pipeline.run(spark, sf_dir)
    assert again.count() == packed.count()
