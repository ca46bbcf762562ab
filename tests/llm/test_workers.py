import gc
import re
import sys
import weakref
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from shelfwatch.llm.packing import WordIds
from shelfwatch.llm.words import BLOCK_BYTES, text_blocks
from shelfwatch.llm.workers import kept, tidy
from tests.llm.helpers import docs_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_that_packing_keeps_go_once_another_operator_reads_texts():
    known = WordIds.shared(PATH)
    known.of(["some words of a document"])
    assert WordIds.shared(PATH) is known  # the next task of packing finds them
    here = weakref.ref(known)
    del known
    batch = pa.RecordBatch.from_pydict({"text": ["a text", None]})
    assert [t for _, t in text_blocks(batch)] == [[b"a text", b""]]
    gc.collect()
    assert here() is None


def test_one_operator_keeps_something_at_a_time():
    first = kept(("one",), lambda: [1])
    assert kept(("one",), lambda: [2]) is first
    assert kept(("two",), lambda: [3]) == [3]
    assert kept(("one",), lambda: [4]) == [4]


def anonymous_mb():
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_worker_gives_back_what_a_task_has_freed():
    pins = []

    def rows(batches):
        for n in batches:
            held = [b"x" * 100_000 for _ in range(n)]
            pins.extend(held[::50])  # so that the heap can't just shrink at its end
            yield len(held)

    before = anonymous_mb()
    assert list(tidy(rows)([600, 600])) == [600, 600]
    assert anonymous_mb() - before < 30


def test_stages_get_texts_by_the_block(spark):
    docs = docs_of(spark, ["x" * 100_000 for _ in range(200)]).coalesce(1)
    corpus_pipeline.pack(spark, docs, "")
    sizes = docs.select("text").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < BLOCK_BYTES + 200_000
