"""Each n-gram length can decide alone."""

import pyarrow as pa

from tidemark.llm import quality_rules


def kept(text, **rules):
    found = quality_rules.measure(pa.array([text]), quality_rules.Rules(**rules))
    return found["kept"][0].as_py()


def test_a_long_repetition_counts_for_more_than_short_ones():
    own = " ".join(f"word{k}" for k in range(135))
    passage = " ".join(f"again{k}" for k in range(14))
    text = f"{own} {passage} between {passage}"  # 28 of 164 words, 17 percent of the letters
    assert not kept(text)
    assert kept(text, ngram_percent={5: 20, 8: 18})
    assert kept(text, ngram_percent={5: 20, 8: 20, 12: 20})


def test_only_the_middle_length_rejects():
    own = " ".join(f"word{k}" for k in range(150))
    passage = " ".join(f"again{k}" for k in range(9))
    text = own
    for k in range(4):
        text += f" {passage} gap{k}"  # 36 of 190 words, 17 percent of the letters
    assert not kept(text, ngram_percent={5: 20, 8: 15, 12: 10})
    assert kept(text, ngram_percent={5: 20, 12: 10})


def test_short_repetitions_may_be_more():
    own = " ".join(f"word{k}" for k in range(200))
    phrase = " ".join(f"some{k}" for k in range(6))
    text = own
    for k in range(5):
        text += f" {phrase} gap{k}"  # 30 of 235 words
    assert kept(text)
