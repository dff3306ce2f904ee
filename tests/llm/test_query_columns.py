"""Every column of the queries op7, op8 and op9 against the libraries and the renderer, text by text."""

import hashlib
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from panelforge.llm import op7_sentencepiece, op8_html, op9_token_files
from panelforge.llm.common import table


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_sentencepiece_query(spark, sf_dir, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=op7_sentencepiece.default_path())
    rows = {r["doc_id"]: r for r in op7_sentencepiece.query(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text)
        found = rows[i]
        assert (found["n_tokens"], found["ids_sha256"], found["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_token_file_query(spark, sf_dir, texts):
    library = Tokenizer.from_file(op9_token_files.default_path())
    rows = {r["doc_id"]: r for r in op9_token_files.query(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    start = 0
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_html_query(spark, sf_dir):
    pages = {r["page_id"]: r["html"] or "" for r in table(spark, sf_dir, "pages").collect()}
    rows = {r["page_id"]: r["text"] for r in op8_html.query(spark, sf_dir).collect()}
    assert rows == {i: op8_html.render(page) for i, page in pages.items()}
