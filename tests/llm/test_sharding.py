from zlib import crc32

import numpy as np

from tallyroll.llm import sharding


def test_permutation_is_a_bijection():
    for total in (1, 2, 3, 7, 16, 17, 1000, 4097):
        assert sorted(sharding.permute(np.arange(total), total)) == list(range(total))
    assert list(sharding.permute(np.arange(1000), 1000, 1)) != list(sharding.permute(np.arange(1000), 1000, 2))


def check(df):
    rows = sharding.shard_documents(df).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    wanted = sorted(((i, len(t.encode()) + 1, crc32(t.encode())) for i, t in texts), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == wanted
    slots = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots)
    counts = [len(s) for s in slots]
    assert max(counts) - min(counts) <= 1
    for r in rows:
        assert sharding.locate(r["row_number"], len(rows)) == (r["shard"], r["slot"])
    return sorted(map(tuple, rows), key=repr)


def test_given_documents_reruns_agree(documents):
    assert check(documents) == check(documents.repartition(13))


def test_awkward_rows(awkward, no_docs):
    check(awkward)
    assert check(no_docs) == []
