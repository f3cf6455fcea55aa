import re

import numpy as np
import pyarrow as pa

from tidemark.llm import shingles as sh

np.seterr(over="ignore")
TEXTS = ["a b c d e f", "", None, " \t", "one", "é ü\x0b日本 x  y\n z w", "a b c d e f", "x" * 5000 + " tail", " nbsp ", "b c d e f g"]


def test_words_and_shingles_match_plain_python():
    seen, n = {}, 0
    for first, last, data, offs in sh.groups(pa.array(TEXTS), 64):
        start, end, doc = sh.word_spans(data, offs)
        h = sh.word_hashes(data, start, end)
        for k in range(first, last):
            want = re.findall(r"[^\x20\x09-\x0D]+", TEXTS[k] or "")
            own = h[doc == k - first]
            assert len(own) == len(want)
            for w, x in zip(want, own):
                assert seen.setdefault(w, x) == x
            n += len(want)
    assert len(set(seen.values())) == len(seen) and n > 20


def test_shingles_are_the_same_wherever_they_stand():
    sets = {}
    for size in (8, 1 << 20):
        for first, last, data, offs in sh.groups(pa.array(TEXTS), size):
            start, end, doc = sh.word_spans(data, offs)
            h, d = sh.shingle_hashes(sh.word_hashes(data, start, end), doc, last - first)
            for k in range(first, last):
                assert sets.setdefault(k, set(h[d == k - first].tolist())) == set(h[d == k - first].tolist())
    assert sets[0] == sets[6] and len(sets[0]) == 2 and len(sets[0] & sets[9]) == 1 and sets[1] == sets[2] == sets[3] == set() and len(sets[4]) == 1
