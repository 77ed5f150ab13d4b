import random

import public_tokenizers
import tiktoken

from plantmetrics.llm.byte_bpe import PrefixTable, codec, decode_ids, encode_documents


def reference():
    coder = codec()
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.vocabulary.ranks, special_tokens={})


def test_equals_reference_on_random_texts():
    rng, own, other = random.Random(1), codec(), reference()
    for _ in range(500):
        text = "".join(rng.choice("ab  \n\té字😀'sll0123!!THEing") for _ in range(rng.randint(0, 80)))
        assert own.encode(text) == other.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()
    long = "a" * 20_000 + "=" * 3_000
    assert own.encode(long) == other.encode_ordinary(long)


def test_prefixes_appends_and_edits():
    rng, vocabulary = random.Random(2), codec().vocabulary
    for _ in range(50):
        data = bytes(rng.choice(b"the inga cat") for _ in range(rng.randint(1, 400)))
        table, start = PrefixTable(vocabulary, data[:7]), rng.randint(0, len(data))
        table.append(data[7:])
        stop = rng.randint(start, len(data))
        assert table.tokens(start) == PrefixTable(vocabulary, data[:start]).tokens()
        table.replace(start, stop, b"edited")
        assert table.last == PrefixTable(vocabulary, data[:start] + b"edited" + data[stop:]).last
    table = PrefixTable(vocabulary, b"the cat sat " * 500)
    assert table.replace(30, 33, b"dog") < 1_000  # only near the edit


def test_documents(spark, documents):
    docs = documents([(1, "Hello  world"), (1, "Hello  world"), (None, "x"), (3, None), (4, "")])
    rows = encode_documents(docs.withColumnRenamed("lang", "token_ids")).collect()
    assert [r.n_tokens for r in rows][3:] == [0, 0] and rows[0] == rows[1] and rows[2].doc_id is None
    assert rows[0].token_ids == reference().encode_ordinary("Hello  world")
    assert bytes(decode_ids(encode_documents(docs)).first().decoded) == b"Hello  world"
    assert encode_documents(docs.limit(0)).count() == 0


def test_caches_go_when_another_operator_begins():
    import pyarrow as pa

    from plantmetrics.llm import arrow, byte_bpe

    coder = byte_bpe.codec()
    coder.encode("some words " + "x" * 1000)
    assert all(len(piece) <= byte_bpe.LONGEST_KEPT for piece in coder.pieces)
    arrow.begin_task(byte_bpe.OWNER)
    assert byte_bpe.codec() is coder
    arrow.begin_task()
    assert not byte_bpe._codecs
    batch = pa.record_batch([pa.array(["y" * 1000] * 50)], names=["text"])
    parts = list(arrow.in_slices(iter([batch]), 10_000))
    assert sum(p.num_rows for p in parts) == 50 and len(parts) >= 5
