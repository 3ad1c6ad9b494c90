import random

import numpy as np
import pytest

from arrivals_mart.llm import bpe_automaton as B

from .data import LONG, clashing, docs, empty

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(B.load_automaton(PATH))


class Explicit:
    """The automaton with states and arcs written out, gadget by gadget."""

    def __init__(self, base):
        self.out = [{t: 0 for t in base}]

    def merge(self, u, v, w):
        for p in range(len(self.out)):
            if u in self.out[p]:
                q = self.out[p][u]
                break
        else:
            return
        if v not in self.out[q]:
            return
        target = self.out[q][v]
        self.out.append({t: s for t, s in self.out[q].items() if t != v})
        copy = len(self.out) - 1
        for arcs in self.out:
            if u in arcs:
                arcs[u] = copy
                arcs[w] = target

    def paths(self, word):
        """All ways to spell ``word`` along arcs."""
        found, todo = [], [(0, 0, ())]
        while todo:
            at, state, path = todo.pop()
            if at == len(word):
                found.append(list(path))
            for t, s in self.out[state].items():
                if word.startswith(t, at):
                    todo.append((at + len(t), s, (*path, t)))
        return found


def sequential(word, merges):
    """Byte-pair encoding by its definition: each merge in turn, left to right."""
    tokens = list(word)
    for a, b in merges:
        out, i = [], 0
        while i < len(tokens):
            if i + 1 < len(tokens) and tokens[i] == a and tokens[i + 1] == b:
                out.append(a + b)
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


def test_gadgets_give_one_path_and_the_same_one_as_the_written_out_automaton():
    rng = random.Random(5)
    for _ in range(40):
        merges, tokens = [], list("abc")
        for _ in range(rng.randint(1, 9)):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens:
                merges.append((a, b))
                tokens.append(a + b)
        vocab = {t: i for i, t in enumerate(tokens)}
        encoder = B.Encoder(B.compile_automaton(vocab, merges, alphabet={c: ord(c) for c in "abc"}))
        explicit = Explicit("abc")
        for a, b in merges:
            explicit.merge(a, b, a + b)
        for _ in range(40):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            want = sequential(word, merges)
            assert explicit.paths(word) == [want]
            assert [tokens[t] for t in encoder.tokens(word.encode())] == want


def test_random_unicode_matches_the_library(reference, encoder):
    rng = random.Random(1)
    pools = [range(32, 127), range(0, 0x300), range(0x300, 0x3000), range(0x3000, 0x12000), range(0x1F000, 0x20000),
             [32, 10, 9, 13, 0xA0, 0x2003, 0x85, 0x1C, 0x200B], [ord(c) for c in "'strevmlld 'S'T’"]]
    for k in range(3000):
        pool = rng.choice(pools)
        text = "".join(chr(c) for c in (rng.choice(pool if rng.random() < 0.8 else rng.choice(pools)) for _ in range(rng.randint(0, 40)))
                       if not 0xD800 <= c < 0xE000)
        if k % 20 == 0:
            text += "<|endoftext|>" + text
        ids = reference.encode(text, add_special_tokens=False).ids
        got = encoder.encode(text)
        assert got.tolist() == ids, repr(text)
        assert encoder.decode(got) == reference.decode(ids, skip_special_tokens=False)


def test_tables_that_fill_up_change_nothing(reference):
    small = B.Encoder(B.load_automaton(PATH), entries=50)
    text = " ".join(f"word{i} Überlänge{i % 7}" for i in range(400)) + "x" * 5000 + "é" * 300
    assert small.encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids
    assert len(small.words) <= 51 and len(small.arcs) <= 51


def test_ids_that_are_no_text_decode_to_replacement_characters(reference, encoder):
    ids = [t for t in range(300)]
    assert encoder.decode(np.array(ids)) == reference.decode(ids, skip_special_tokens=False)


def test_documents(spark, reference):
    df = clashing(docs(spark))
    rows = [tuple(r) for r in docs(spark).collect()]
    out = B.encode_decode(df, PATH).collect()
    assert len(out) == len(rows)
    for got, (doc_id, text, *_) in zip(out, rows):
        assert got.row.doc_id == doc_id and got.row["kept"] == "own kept"
        assert got.ids == reference.encode(text or "", add_special_tokens=False).ids
        assert got.decoded == (text or "")
    assert any(r.decoded == LONG for r in out)
    assert B.encode_decode(empty(spark), PATH).count() == 0
