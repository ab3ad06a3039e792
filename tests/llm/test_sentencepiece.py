import hashlib
import struct

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import sentencepiece as library  # noqa: E402

from scrimtally.llm import sentencepiece as op  # noqa: E402

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "   a", "a  b ▁c\n d ", "\n a", "a" * 500, " " * 40 + "x" + " " * 19, "▁", "▁▁x▁",
    "\x00x  é😀 \t", "<s>x</s><unk> <0x41> ▁▁<unk>", "　ａ①\r\n b", "the same the same", "word " * 3000,
]


@pytest.mark.parametrize("limit", [3, 100_000])
def test_chunks_give_the_library_s_ids(limit):
    table = op.ChunkTable(PATH, limit)
    for text in TEXTS + TEXTS:
        ids = table.model.encode(text, add_bos=True, add_eos=True)
        chunks = table.encode(text)
        assert table.ids_of(chunks) == struct.pack(f"<{len(ids)}I", *ids)
        assert table.decoded(chunks) == table.model.decode(ids)


def test_a_vocabulary_that_crosses_markers_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(library.SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError):
        op.ChunkTable(PATH)


def test_documents(docs):
    model = library.SentencePieceProcessor(model_file=PATH)
    pairs = [*enumerate(TEXTS), (99, None), (None, "no id"), (1, TEXTS[3])]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op.token_digests(docs(pairs), PATH).collect()}
    want = set()
    for i, t in pairs:
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.add((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert got == want
    full = op.encode_documents(docs(pairs), PATH).filter("doc_id = 4").first()
    assert full.ids == model.encode(TEXTS[4], add_bos=True, add_eos=True) and full.decoded == model.decode(full.ids)
    assert op.token_digests(docs([]), PATH).count() == 0
