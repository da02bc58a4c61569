"""Every stage of the pipeline against plain Python, on the rows its predecessor kept."""
from __future__ import annotations

from collections import Counter, defaultdict

import pytest
import sentencepiece

import __spark_entry__
import corpus_pipeline
from dayloom.llm import pieces
from dayloom.llm.common import keep
from tests.llm.helpers import DOCUMENTS, with_clashes
from tests.llm.test_native import WORD, base_spans, entropy_spans, reference_targets
from tests.llm.test_setjoin import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each."""
    docs = with_clashes(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(keep(stage(spark, out[-1], FOLDER), "stage"))
    return out


def test_columns_stay_until_the_last_stage(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_rejected_documents_go_and_clean_ones_stay(spark, stages):
    before, kept = {r["doc_id"]: r["text"] for r in stages[0].collect()}, {r["doc_id"] for r in stages[1].collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for i, text in before.items():
        words = WORD.findall(text or "")
        seen = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeated = {p for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        if failed:
            assert i not in kept
        elif i in quality:  # the two kinds of the labelled rows are told apart by symbols alone
            assert (i in kept) == (not quality[i] == 0 or sum(text.count(c) for c in "#*$%&|<>") == 0)


def test_one_document_of_each_group_stays(stages):
    found = brute([(r["doc_id"], r["text"]) for r in stages[1].collect()])
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted({c for c, _, _ in found.values()})


def test_secrets_are_masked(stages):
    clean = {r["doc_id"]: r for r in stages[3].collect()}
    masked = 0
    for r in stages[2].collect():
        text, out, end = r["text"], "", 0
        for s, _, e in sorted(base_spans(text) + entropy_spans(text)):
            if s > end or not out and end == 0:
                out += text[end:s] + "[SECRET]"
                masked += 1
            end = max(end, e)
        assert clean[r["doc_id"]]["text"] == out + text[end:] and clean[r["doc_id"]]["n_chars"] == len(out + text[end:])
    assert masked and len(clean) == stages[2].count()


def test_sources_meet_their_targets(stages):
    sizes, taken, times = defaultdict(int), defaultdict(int), Counter()
    for r in stages[3].collect():
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    before = {r["doc_id"]: r for r in stages[3].collect()}
    for r in stages[4].collect():
        assert r == before[r["doc_id"]]
        taken[r["source"]] += len(WORD.findall(r["text"]))
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 2
    for source, target in reference_targets(sizes).items():
        assert abs(taken[source] - target) <= max(1, 0.01 * target)


def test_ids_are_those_of_the_library(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = Counter((r["doc_id"], tuple(library.encode(r["text"]))) for r in stages[4].collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages[5].collect()) == want


def test_run_is_the_stages_in_order_and_is_registered(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r["doc_id"], r["text_sha256"]) for r in rows.collect()) == sorted((r["doc_id"], r["text_sha256"]) for r in stages[5].collect())
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_empty_and_odd_documents_pass_through(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "x " * 50, None, None, 100), (3, "y", "en", "s", 1), (3, "y", "en", "s", 1)]
    for docs in (spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame([], DOCUMENTS)):
        for _, stage in corpus_pipeline.STAGES:  # each on all rows, as the first stage would drop these
            out = stage(spark, docs, FOLDER)
            assert out.count() <= 2 * len(rows)
