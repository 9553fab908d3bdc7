import os
import tempfile

from basketry.operators.text import word_count


def test_word_count_applies_to_a_stream(spark):
    src = tempfile.mkdtemp(prefix="basketry-stream-src-")
    for name, text in (("a.txt", "a b a\n\tc\n"), ("b.txt", "b  b\fa\n")):
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    counts = word_count(spark.readStream.text(src))
    assert counts.isStreaming
    q = counts.writeStream.outputMode("complete").format("memory").queryName("stream_words").start()
    try:
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.table("stream_words").collect()}
    finally:
        q.stop()
    assert got == {"a": 3, "b": 3, "c": 1}
