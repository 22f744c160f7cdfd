"""What finding sentences takes of a worker's memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from civiltext.llm import sentence_spans as sp
from civiltext.llm.words import find_words


def test_line_breaks_take_no_number_per_byte():
    """op10: the arrays go by the words, not by the bytes."""
    words = find_words(pa.array([("a" * 999 + "\n" + "b" * 999 + " ") * 1000]))
    tracemalloc.start()
    begins, first = sp.sentences(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert begins.tolist() == [*range(0, 2000, 2)][:1] + [*range(1, 2000, 2)] + [2000]
    assert peak < 2 * len(words.data)


def test_breaks_between_words():
    texts = ["one two\nthree\n\nfour", "\nfive six\r\n", "", "seven\x0beight nine", "ten"]
    words = find_words(pa.array(texts))
    begins, first = sp.sentences(words)
    assert begins.tolist() == [0, 2, 3, 4, 6, 7, 9, 10]
    assert np.diff(first).tolist() == [3, 1, 0, 2, 1]
