"""Groups and links of two tokenizers against plain loops over byte ranges, and on awkward rows."""

import hashlib
from collections import Counter, deque

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfmark.llm import alignment

SMALL = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(n) for n in (alignment.BYTE_LEVEL, alignment.PIECES)]
ROWS = "doc_id long, text string, block int, pair string, links int, place int, count int, best int, n_a string"
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t  "), (4, "one word"), (4, "one word"), (5, "a ▁ sign"), (6, "<|endoftext|> <s> </s> <0x41> <unk>"),
    (7, "ünïcödé 日本語 \U0001f600 ́"), (8, "lorem ipsum dolor " * 20_000), (None, "no id"), (9, "x" * 5_000), (10, "\x00\x01"),
    (11, " leading  and double "), (2**60 + 1, "a large id"),
]


@pytest.fixture(scope="module")
def plain():
    """Spans (id, start, end) of both sides, worked out token by token."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(sorted(set(range(256)) - set(visible)))}

    def spans(ids, data):
        out, at = [], 0
        for i, d in zip(ids, data):
            out.append((i, at, at + len(d)))
            at += len(d)
        return out

    def both(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return [], []
        return spans(ids_a, bytes_a), spans(ids_b, bytes_b)

    return both


def expected(rows, both):
    pairs, made = Counter(), []
    for i, text in rows:
        a, b = both(text or "")
        ends_b = {e: (x, s) for x, s, e in b}
        links = [(x, ends_b[e][0]) for x, _, e in a if e in ends_b]
        groups, left, right = [], [], deque(b)
        for x, _, end in a:
            left.append(str(x))
            if end in ends_b:
                taken = []
                while right and right[0][2] <= end:
                    taken.append(str(right.popleft()[0]))
                groups.append(",".join(left) + "|" + ",".join(taken))
                left = []
        pairs.update(links)
        made.append((i, len(a), len(b), groups, links))
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    out = []
    for i, n_a, n_b, groups, links in made:
        text = ";".join(groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        best = sum(pairs[p] == most[p[1]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(pairs[p] for p in links), digest, text))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_on_the_table(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted([tuple(r) for r in alignment.op11_alignment(spark, SMALL).select(COLUMNS).collect()], key=repr)
    assert found == [r[:-1] for r in expected(rows, plain)]


@pytest.mark.parametrize("chars", [1, 50, 4_000_000])
def test_awkward_rows_in_blocks_of_any_size(spark, plain, monkeypatch, chars):
    blocks = alignment._blocks

    def smaller(batches):
        for batch in blocks(batches):
            number = (batch["text"].str.len().cumsum() - 1) // chars
            yield from (b for _, b in batch.groupby(number, sort=False))

    monkeypatch.setattr(alignment, "_blocks", smaller)
    df = spark.createDataFrame([(i, t, 1, "p", 1, 1, 1, 1, "n") for i, t in AWKWARD], ROWS).repartition(3)
    found = alignment.align(df, *PATHS).select(*COLUMNS, "groups").collect()
    assert sorted([tuple(r) for r in found], key=repr) == expected(AWKWARD, plain)


def test_nothing_to_align(spark):
    empty = spark.createDataFrame([], ROWS)
    assert alignment.align(empty, *PATHS).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r)[1:7] for r in alignment.align(blank, *PATHS, whole=False).collect()] == [(0,) * 6] * 2
