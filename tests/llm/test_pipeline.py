"""The corpus pipeline stage by stage against plain Python, and the registered queries against their SQL statements."""

import zlib
from collections import Counter

import compare
import pytest
from test_operators import plain_components, plain_hits
from tokenizers import Tokenizer

import corpus_pipeline
from tablespoon.llm import queries
from tablespoon.session import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), name))
    return out


def by_id(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_all_but_the_last_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_copies", "decontamination", "source_mix", "token_files",
    ]
    assert all(df.schema.simpleString() == stages[0].schema.simpleString() for df in stages[:-1])


def test_near_copies_leave_one_of_each_group(stages):
    before = by_id(stages[1])
    groups = plain_components([r.text for r in before], 5, 80)
    wanted = [before[i].doc_id for i, (_, component) in enumerate(groups) if component == i]
    assert [r.doc_id for r in by_id(stages[2])] == wanted


def test_contaminated_documents_go(spark, stages):
    before = by_id(stages[2])
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = plain_hits([r.text for r in before], items, 13)
    wanted = [r.doc_id for r, (n, hit, _) in zip(before, hits) if not (hit > 0 and 20 * hit >= n)]
    assert [r.doc_id for r in by_id(stages[3])] == wanted


def test_mix_repeats_whole_rows(stages):
    before, after = Counter(map(tuple, stages[3].collect())), Counter(map(tuple, stages[4].collect()))
    assert set(after) <= set(before) and all(n <= 2 * before[row] for row, n in after.items())


def test_token_files_hold_the_mixed_texts(stages):
    encoder = Tokenizer.from_file(queries.vocabulary())
    wanted = Counter()
    for r in stages[4].collect():
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted[r.doc_id, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))] += 1
    found = stages[5].orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    total = 0
    for r in found:
        assert r.start == total
        total += r.n_tokens


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_statement(spark, key):
    assert compare.differences(queries.QUERIES[key](spark, SF), compare.connect(SF), queries.ORACLE[key]) == []
