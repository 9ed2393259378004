import random

import pyarrow as pa
import pytest

from newsloom.llm import tokens

PIECES = ["a", "word", "Word.", "don't", "x!?", "é.", "ǉ,", "日本", "12", ".", "...", "\n", "\n\n", " ", "  ", "\t", "\r\n", "\xa0", "\x85",
          "<|endoftext|>", "\x01", "\x02", "\x03", "😀", "ab;c", "ß:", "\x1c", "'s", ":!"]


@pytest.mark.parametrize("remembered", [800_000, 5])
def test_ids_are_those_of_whole_texts_and_words_are_kept_in_columns(monkeypatch, remembered):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    whole, rng = Tokenizer.from_file(file), random.Random(5)
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    with open(file, encoding="utf-8") as text:
        encoder = tokens.Encoder(text.read(), "<u2")
    for _ in range(60):
        texts = [None if rng.random() < 0.05 else "".join(rng.choice(PIECES) + " " * rng.randrange(2) for _ in range(rng.randrange(14)))
                 for _ in range(rng.randrange(12))]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        want = [whole.encode(t or "", add_special_tokens=False).ids + [tokens.END] for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w], texts
    # Thousands of words a column: none of them is a Python object afterwards, and each takes some tens of bytes.
    encoder.encode(pa.array([" ".join(f"w{i}x" for i in range(4_000))]))
    assert isinstance(encoder.known, pa.Array)
    assert encoder.known.nbytes + encoder.known_ids.nbytes + encoder.known_sizes.nbytes < 60 * len(encoder.known) + 10_000


def test_a_call_hashes_its_own_words_only_and_words_of_letters_go_to_the_model(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    whole, hashed, texts = Tokenizer.from_file(file), [], []
    with open(file, encoding="utf-8") as text:
        encoder = tokens.Encoder(text.read(), "<u2")
    encoder.encode(pa.array([" ".join(f"w{i}x" for i in range(20_000))]))
    index_in, ids_of = tokens.pc.index_in, encoder._ids
    monkeypatch.setattr(tokens.pc, "index_in", lambda values, value_set: hashed.append(len(value_set)) or index_in(values, value_set=value_set))
    monkeypatch.setattr(encoder, "_ids", lambda text: texts.append(text) or ids_of(text))
    letters = [c for c in map(chr, range(0x41, 0x250)) if c.isalpha()]
    rng = random.Random(7)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) for _ in range(500)]
    for text in (" ".join(words), "\n".join(words), "w3x Mot. don't"):
        ids, counts = encoder.encode(pa.array([text]))
        assert ids.tolist() == [*whole.encode(text, add_special_tokens=False).ids, tokens.END] and counts.tolist() == [len(ids)]
    # A call's work does not grow with the words known before it.
    assert hashed and max(hashed) < 2 * len(words)
    # Only words with other characters than Latin letters take the way through the text's pattern.
    assert sum(map(len, texts)) < len("".join(words)) / 4


def test_letters_are_not_taken_apart_where_a_special_token_could_hide_in_them():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.add_special_tokens(["stop"])
    encoder = tokens.Encoder(whole.to_str(), "<u4")
    text = "nonstop words stop, stopping"
    assert encoder.encode(pa.array([text]))[0].tolist() == [*whole.encode(text, add_special_tokens=False).ids, tokens.END]


def test_words_met_again_are_kept_when_others_are_forgotten(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "REMEMBERED", 1_000)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as text:
        encoder = tokens.Encoder(text.read(), "<u2")
    often = " ".join(f"often{i}x" for i in range(50))
    encoder.encode(pa.array([often]))
    for call in range(8):
        if call % 4 == 0:
            encoder.encode(pa.array([often]))
        encoder.encode(pa.array([" ".join(f"once{call}y{i}" for i in range(300))]))
        assert len(encoder.known) == len(encoder.known_sizes) == len(encoder.again) <= 1_000
        assert len(set(encoder.known.to_pylist())) == len(encoder.known) and encoder.known_sizes.sum() == len(encoder.known_ids)
    assert {f"often{i}x" for i in range(1, 50)} <= set(encoder.known.to_pylist())


def test_ids_are_counted_where_they_are_made(spark, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(tokens, "BLOCK", 40)
    names, rows, kept, save = [], [(i % 7, f"word{i} and {'x' * i}.") for i in range(60)] + [(None, None), (3, "")], [], tokens.saved
    monkeypatch.setattr(tokens, "saved", lambda frame, name: kept.append(save(frame, name)) or names.append(name) or kept[-1])
    found = tokens.round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), public_tokenizers.path("byte_bpe_50k.json"))
    found, blocks = found.collect(), kept[0].collect()
    assert len(found) == len(rows) and names == ["token-ids"]
    counted = {}
    for row in blocks:
        for token, n in zip(row.seen or [], row.times or []):
            counted[token] = counted.get(token, 0) + n
    want = {}
    for row in found:
        for token in memoryview(bytes(row.ids)).cast("I"):
            want[token] = want.get(token, 0) + 1
    assert counted == want and sum(r.n for r in blocks) == sum(want.values())
