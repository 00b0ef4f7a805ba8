"""Rounds of drawn heads in large buckets."""
import random

from sitewright.llm import ngram_join


def test_chains_of_near_copies_in_large_buckets(spark):
    """Near copies that hang together by chains keep exactly the components of all links."""
    rnd = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    texts = [rnd.sample(words, 60)]
    for _ in range(500):
        t = list(rnd.choice(texts[-60:]))
        t[rnd.randrange(3)] = rnd.choice(words)
        texts.append(t)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs, n=4, percent=90).collect()}
    sets = [{tuple(t[k:k + 4]) for k in range(57)} for t in texts]
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert got == {i: find(i) for i in range(len(texts))}
