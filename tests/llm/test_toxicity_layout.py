"""The lexicon does not depend on how the sample is dealt over partitions."""

import random

from veriforge.llm import toxicity


def test_lexicon_is_the_same_for_any_layout(spark):
    r = random.Random(1)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    rows = [(i, " ".join(r.sample(words, 30)) + (" grubber" if i % 12 == 0 else ""), int(i % 12 == 0)) for i in range(600)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    one, many = (toxicity.train(docs.repartition(n), labels).lexicon for n in (1, 60))
    assert one == many and set(one) == {"grubber"}
