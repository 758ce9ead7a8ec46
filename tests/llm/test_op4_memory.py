"""What the tokenizer holds of the words it has met, which is what a Python worker grows by in a task."""

import gc
import random
import tracemalloc
from struct import unpack

from tokenizers import Tokenizer

from tessera.llm import bpe
from tessera.llm.queries import tokenizer_path


def test_words_met_cost_few_bytes():
    r = random.Random(3)
    words = list({"".join(r.choices("abcdeinorst", k=r.randrange(4, 12))) for _ in range(20_000)})
    tok = bpe.Tokenizer(tokenizer_path())
    tracemalloc.start()
    for w in words:
        tok.encode(w)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert set(words) <= set(tok.known)
    assert held < 1050 * len(words)

    ids = tok.encode(text := " ".join(words))
    assert list(unpack(f"<{len(ids) // 4}I", ids)) == Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
