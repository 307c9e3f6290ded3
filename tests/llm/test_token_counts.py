"""Token counts where composing and lower-casing do not commute."""

import string

import public_tokenizers

from ledgerline.llm import token_counts


def test_marks_after_capitals(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library = Tokenizer.from_file(path)
    marks = [chr(m) for m in range(0x300, 0x370)]
    texts = [c + m for c in string.ascii_uppercase for m in marks] + ["THE J\u030c END", "Ab J\u20d8\u030c", "J\u0323\u030cX Y", "j\u030c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert token_counts.pre_tokens("THE J\u030c END".encode()) == [b"the", "J\u030c".encode(), b"end"]
