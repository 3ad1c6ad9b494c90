import random
from functools import cache

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrivals_mart.llm import queries as Q
from arrivals_mart.llm import token_counts as C
from arrivals_mart.llm.bpe_automaton import PRE_SPLIT

from .data import DOCS, clashing, docs, empty

PIECES = list("aBcstmdrvelLE  \n\t'’12é漢!?-_ 　\ŕ") + ["'s", "'re", "'ll", "  ", "<|endoftext|>", "don't", "'r", "𝔘"]


@cache
def counter():
    return C.load_counter(Q.tokenizer_path())


@cache
def library():
    return Tokenizer.from_file(Q.tokenizer_path())


def wanted(texts):
    return [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]


def made(seed, n=4000, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("chunks", [1, 3, 64, 2048])
def test_splitter_marks_the_words_of_the_pattern(chunks):
    classes = C.character_classes()
    texts = [t.replace("<|endoftext|>", "") for t in made(chunks, 800)]
    whole = "\n".join(texts) + "\n"
    found = classes[np.frombuffer(whole.encode("utf-32-le"), np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    found[ends] = C.END
    begins, at = [], 0
    for t in texts:
        begins += [at + m.start() for m in regex.finditer(PRE_SPLIT, t)]
        at += len(t) + 1
    assert np.flatnonzero(C.word_starts(found, chunks)).tolist() == begins


def test_scanned_maps_equal_maps_one_after_the_other():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 100):
        maps = rng.integers(0, len(C.STATES), (n, len(C.STATES)))
        want, at = [], np.arange(len(C.STATES))
        for m in maps:
            at = m[at]
            want.append(at.tolist())
        assert C.prefix_scan(maps).tolist() == want
    chunks = rng.integers(0, len(C.CLASSES), (5, 9)).astype(np.uint8)
    for row, got in zip(chunks, C.chunk_maps(chunks)):
        for entry in range(len(C.STATES)):
            at = entry
            for c in row.tolist():
                at = C._transition(at, c)[0]
            assert got[entry] == at


def merged_length(word, merges):
    """Tokens of a word by applying the merges one by one, each from left to right."""
    tokens = list(word)
    for a, b in merges:
        i = 0
        while i < len(tokens) - 1:
            if tokens[i] == a and tokens[i + 1] == b:
                tokens[i:i + 2] = [a + b]
            i += 1
    return len(tokens)


def test_counter_equals_merging_for_random_vocabularies():
    rng = random.Random(2)
    for _ in range(60):
        tokens, merges = list("abc"), []
        for _ in range(rng.randint(0, 25)):
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair not in merges and len("".join(pair)) < 12:
                merges.append(pair)
                if "".join(pair) not in tokens:
                    tokens.append("".join(pair))
        # the library merges by rank, which is the order of the list where parts come before what they make
        counter = C.compile_counter({t: i for i, t in enumerate(tokens)}, merges)
        for _ in range(60):
            word = "".join(rng.choices("abc", k=rng.randint(1, 20)))
            assert counter.count(word.encode()) == merged_length(word, merges), (merges, word)


def test_texts_equal_the_library():
    texts = made(3) + ["a" * 5000, " " * 777, "ab" * 3000 + "\n\n", "=" * 999, "x" * 400 + " y" * 400]
    assert C.TextCounter(counter()).counts(texts).tolist() == wanted(texts)


def test_small_chunks_pieces_blocks_and_tables(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_CHARS", 300)
    monkeypatch.setattr(C, "PIECE_CHARS", 50)
    monkeypatch.setattr(C, "TABLE_WORDS", 40)
    texts = made(4, 600, 400)
    assert C.TextCounter(counter(), 5).counts(texts).tolist() == wanted(texts)


def test_counter_goes_back_to_its_compiled_part():
    c, rng = counter(), random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30)) for _ in range(300)]
    before = c.compiled
    assert [c.count(w.encode(), 25) for w in words] == wanted(words)
    assert len(c.states) <= before[0] + 26 and c.compiled == before
    assert len(c.number) == len(c.states)


def test_every_token_is_one_token():
    c = counter()
    assert c.compiled[0] == len(c.ends) and c.compiled[1] == len(c.trie)


def test_the_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in Q.op12_token_counts(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r, n in zip(rows, wanted([r.text or "" for r in rows])):
        g = got[r.doc_id]
        assert (g.n_bytes, g.n_tokens, g.over_limit) == (len((r.text or "").encode()), n, n > 1024)


def test_awkward_rows_clashing_columns_and_empty_table(spark):
    df = clashing(docs(spark)).withColumn("n_tokens", F.lit("own"))
    got = C.token_counts(df, Q.tokenizer_path()).collect()
    want = sorted(zip([str(r[0]) for r in DOCS], wanted([r[1] or "" for r in DOCS])))
    assert sorted((str(r.row.doc_id), r.n_tokens) for r in got) == want
    assert all(r.row.n_tokens == "own" and r.over_limit == (r.n_tokens > 1024) for r in got)
    assert C.token_counts(empty(spark), Q.tokenizer_path()).count() == 0
