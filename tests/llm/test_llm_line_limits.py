"""Lines that are frequent by number in a host where they have a small share."""

import corpus_pipeline


def test_a_long_line_below_the_share_goes_and_a_short_one_stays(spark):
    own = "number {0} a{0} b{0} c{0} d{0} e{0} f{0} g{0} h{0} i{0} j{0} k{0} l{0} m{0}"
    line, short = "please share this page with all of your friends", "read more"
    texts = [f"{line}\n{short}\n{own.format(i)}" if i % 12 == 0 else own.format(i) for i in range(360)]  # 30 documents of 360
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    clean = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert len(clean) == 360 and clean[12] == f"{short}\n{own.format(12)}" and clean[1] == texts[1]
