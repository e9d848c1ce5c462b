"""What a Python worker holds over its tasks."""

from catalogue.llm import langid, packing, records
from catalogue.llm.tokens import encoder, vocabulary_path
from catalogue.llm.workers import bounded, map_batches

from .helpers import table


def held():
    return encoder.cache_info().currsize


def test_a_task_of_another_kind_lets_go():
    encoder(vocabulary_path()).encode([b"some words"])
    langid._automata((("en", b"some words"),))
    assert [*bounded(iter, "encoder")([1, 2])] == [1, 2]
    assert (held(), langid._automata.cache_info().currsize) == (1, 0)
    seen = bounded(lambda batches: ((b, held()) for b in batches))([1, 2])
    assert [*seen] == [(1, 0), (2, 0)]


def test_workers_hold_no_encoder_after_packing(spark):
    def look(batches):
        import pyarrow as pa

        from catalogue.llm.tokens import encoder

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([encoder.cache_info().currsize])], names=["n"])

    packing.pack(table(spark)).count()
    records.write_records(table(spark)).count()
    # more tasks than a session has workers from before, so that those that encoded are among them
    assert {r["n"] for r in map_batches(spark.range(0, 64, 1, 64), look, "n long").collect()} == {0}
