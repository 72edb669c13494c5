"""Each operator against a plain computation, and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    language,
    line_dedup,
    near_copies,
    personal,
    quality,
    simhash,
    token_counts,
    token_files,
)
from shelfmark.llm.components import components

SMALL = "/root/testdata/sf0.001"
DOCS = (
    "doc_id long, text string, lang string, keep_id string, h int, kept int, fp int, score string, "
    "start int, gone int, base int, spans int, of_id int, root int, terms int"
)
LONG = "lorem ipsum dolor " * 20_000
LINE = "This very line of more than forty letters comes again."
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one word"), (5, "one word"), (5, "one word"), (6, LONG),
    (7, "ünïcödé 日本語 \U0001f600 ́"), (8, f"{LINE}\nfirst"), (9, f"  {LINE.upper()}\nsecond\n"),
    (10, f"{LINE}\n{LINE}"), (11, LINE), (12, f"x\n{LINE}"), (None, LINE), (None, None),
    (2**60 + 1, "a large id"), (14, "<|endoftext|> special a<|endoftext|>b"), (15, "x" * 3000),
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward rows with columns whose names the operators use themselves."""
    rows = [(i, t, "en", "k", 1, 1, 1, "s", 1, 1, 1, 1, 1, 1, 1) for i, t in AWKWARD]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1), (4, 1), (5, 0), (5, 1), (6, 0), (7, 1), (8, None), (None, 0), (99, 0)],
        "doc_id long, quality int",
    )


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def test_exact_dedup(docs, none):
    got = pairs(exact_dedup.mark_copies(docs, piece_bytes=8), "keep_id", "group_size", "kept", "text_sha256")
    assert got == pairs(exact_dedup.mark_copies(docs), "keep_id", "group_size", "kept", "text_sha256")
    want, seen = [], set()
    for i, text in AWKWARD:
        same = [j for j, t in AWKWARD if (t or "") == (text or "")]
        keep = max((j for j in same if j is not None), default=None)
        first = i == keep and (i, text or "") not in seen
        seen.add((i, text or ""))
        want.append((i, keep, len(same), first, sha(text or "")))
    assert got == sorted(want, key=repr)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({t or "" for _, t in AWKWARD})
    assert exact_dedup.mark_copies(none).count() == 0


def test_line_dedup(docs, none):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holds = {}
    for i, text in AWKWARD:
        for line in (text or "").split("\n"):
            holds.setdefault(key(line), set()).add(i)
    want = []
    for i, text in AWKWARD:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            ids = {j for j in holds[key(line)] if j is not None}
            if len(key(line)) < 40 or len(ids) < 5 or i == max(ids):
                stay.append(line)
        want.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    got = pairs(line_dedup.drop_shared_lines(docs), "text", "n_lines", "n_dropped")
    assert got == sorted(want, key=repr) and sum(w[3] for w in want) >= 5
    assert line_dedup.drop_shared_lines(none).count() == 0


def test_bpe(docs, none):
    path = public_tokenizers.path(bpe.TOKENIZER)
    library = Tokenizer.from_file(path)
    want = []
    for i, text in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(decoded), ids, decoded))
    columns = ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
    assert pairs(bpe.encode_decode(docs, path), *columns) == sorted(want, key=repr)
    assert bpe.encode_decode(none, path).count() == 0


LETTERS = ["a", "B", " ", "  ", "\n", "'s", "'re", "'", "é", "1", "23", "\x1c", "\x85", "　", "日本", "!?", "́",
           "<|endoftext|>", "<|end", "ə", "ª", "İ", "x" * 250, "word", "Σ", "."]


def drawn(n, seed):
    random.seed(seed)
    return ["".join(random.choice(LETTERS) for _ in range(random.randrange(40))) for _ in range(n)]


def test_bpe_and_token_files_encode_as_the_library():
    for name, make in ((bpe.TOKENIZER, bpe.load), (token_files.TOKENIZER, token_files.encoder)):
        path = public_tokenizers.path(name)
        library, texts = Tokenizer.from_file(path), drawn(400, 1)
        for text, ids in zip(texts, make(path).encode_all(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_token_files(docs, none):
    path = public_tokenizers.path(token_files.TOKENIZER)
    library = Tokenizer.from_file(path)
    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = token_files.read_documents(token_files.pack_documents(rows, path)).orderBy("doc_id").collect()
    start = 0
    for row, (i, text) in zip(got, sorted({(i, t) for i, t in AWKWARD if i is not None}), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row) == (i, start, len(ids), crc, ids)
        start += len(ids)
    assert token_files.read_documents(token_files.pack_documents(docs, path)).count() == len(AWKWARD)
    assert token_files.read_documents(token_files.pack_documents(none, path)).count() == 0


def test_short_items_are_found_verbatim(spark):
    items = spark.createDataFrame(
        [(1, "Short  one"), (2, "x"), (3, ""), (4, None), (5, "one two\tthree four"), (6, "a much longer item of the benchmark, in one line")],
        "item_id LONG, text STRING",
    )
    texts = {1: "a short\none here", 2: "shorter ones", 3: "X marks", 4: None, 5: "", 6: "zero one TWO three four five, short one short one",
             7: "ten two three four", 8: "it was a much longer item of a benchmark, in one line"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    found = decontaminate.find_passages(docs, items).collect()
    want = {(1, 1), (3, 2), (6, 1), (6, 5), (8, 6)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)
    assert all((r["distance"] == 0) == (r["item_id"] != 6) for r in found)


def test_grammars_are_whole():
    """Rules are made until no pair repeats enough, and a vocabulary that 16 bits cannot hold is refused."""
    random = np.random.default_rng(3)
    ids = np.concatenate([random.permutation(40), *[np.arange(k, k + 9) for k in random.integers(0, 30, 4000)]])
    lengths = np.array([ids.size // 2, ids.size - ids.size // 2])
    block = token_files.Block(token_files.pack(np.arange(2), np.ones(2, bool), ids, lengths, 40))
    assert np.array_equal(block.expand(block.symbols), ids)
    inner = np.ones(block.symbols.size - 1, bool)
    inner[block.starts[1:] - 1] = False
    pairs = np.stack([block.symbols[:-1], block.symbols[1:]], axis=1)[inner]
    # of a pair that overlaps others in a run, fewer occurrences can be replaced than there are
    counts = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0, return_counts=True)[1]
    assert len(block.rules) > 100 and counts.max() < 2 * token_files.LEAST_COUNT
    assert (counts >= token_files.LEAST_COUNT).sum() <= 5
    with pytest.raises(ValueError, match="16 bits"):
        token_files.pack(np.arange(1), np.ones(1, bool), ids[:5], np.array([5]), (1 << 16) + 1)


def test_grammar_decodes_parts():
    random_ids = np.random.default_rng(4)
    lengths = np.array([1, 500, 3, 4000, 1, 2000])
    ids = np.repeat(random_ids.integers(0, 12, 300), 22)[: lengths.sum()]
    ids[::7] = 9
    block = token_files.Block(token_files.pack(np.arange(6), np.ones(6, bool), ids, lengths, 20))
    assert len(block.rules) and block.symbols.size < ids.size / 2
    assert (block.expand(block.symbols) == ids).all()
    for k, begin in enumerate(np.cumsum(lengths) - lengths):
        own = ids[begin : begin + lengths[k]]
        assert (block.document(k) == own).all()
        for a, b in ((0, 1), (0, len(own)), (len(own) // 2, len(own)), (len(own) // 3, len(own) // 2)):
            assert (block.part(k, a, b) == own[a:b]).all()


def test_token_counts(spark, docs, none):
    path = public_tokenizers.path(bpe.TOKENIZER)
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    tokenizer = bpe.load(path)
    random.seed(3)
    for text in drawn(300, 2):
        chunks = bpe.CHUNK.findall(text)
        tokenizer.learn(set(chunks))
        tree = token_counts.CountTree(
            text, np.array([len(c) for c in chunks], np.int64),
            np.array([len(tokenizer.known[c]) // 4 for c in chunks], np.int64),
        )
        for _ in range(5):
            start = random.randrange(len(text) + 1)
            stop, new = min(len(text), start + random.choice([0, 1, 5])), random.choice(LETTERS)
            tree.edit(start, stop, new, tokenizer)
            text = text[:start] + new + text[stop:]
            assert tree.whole() == text
            assert tree.tokens[1] == len(library.encode(text, add_special_tokens=False).ids)
    edits = spark.createDataFrame(
        [(4, 1, 0, 3, "two"), (4, 2, 100, 200, "!"), (7, 1, None, 2, "x"), (6, 1, 5, 9, None), (None, 1, 0, 0, "n")],
        "doc_id long, seq int, start long, stop long, text string",
    )
    got = token_counts.apply_edits(token_counts.build_trees(docs, path, edits), path).collect()
    assert {r.text for r in got if r.doc_id == 4} == {"two word!"}
    assert {r.text for r in got if r.doc_id == 6} == {LONG[:5] + LONG[9:]}
    for r in got:
        assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids)
    assert len(got) == len(AWKWARD) and max(r.n_chars_reencoded for r in got) < 100
    assert token_counts.apply_edits(token_counts.build_trees(none, path), path).count() == 0
    counts = sorted(map(str, token_counts.recount(docs, path, edits).collect()))
    assert counts == sorted(str(type(r)(**{k: v for k, v in r.asDict().items() if k != "text"})) for r in got)


def brute_fingerprint(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def test_simhash(docs, none):
    got = simhash.near_groups(docs).collect()
    assert len(got) == len(AWKWARD)
    texts = dict(AWKWARD)
    for r in got:
        if r.doc_id is not None and r.doc_id != 6:
            assert r.fp & (2**64 - 1) == brute_fingerprint(texts[r.doc_id] or "")
    zero = [r.component_id for r in got if r.fp == 0]
    assert len(zero) == 4 and set(zero) == {1}
    assert simhash.near_groups(none).count() == 0


def test_vantage_points_lose_no_link():
    random_bits = np.random.default_rng(8)
    far = random_bits.integers(0, 2**63, 3000, np.uint64)
    near = far[:800] ^ (np.uint64(1) << random_bits.integers(0, 64, 800).astype(np.uint64))
    close = np.uint64(7) ^ (np.uint64(1) << random_bits.integers(0, 12, 400).astype(np.uint64))
    close ^= np.uint64(1) << random_bits.integers(0, 12, 400).astype(np.uint64)
    points = np.unique(np.concatenate([far, near, close]))
    tree = simhash.plant(points[:: 3], len(points), shard=200, least=8)
    found = [link for _, some in tree.deal(points) for link in simhash.close_links(some)]
    for links in (found, simhash._probed(points)):
        root = {int(p): int(p) for p in points}

        def least(p, root=root):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in links:
            assert (a ^ b).bit_count() <= 2
            a, b = sorted((least(a), least(b)))
            root[b] = a
        for i, p in enumerate(points):
            for q in points[i + 1 :][np.bitwise_count(points[i + 1 :] ^ p) <= 2]:
                assert least(int(p)) == least(int(q))


def edited(words, share, rng):
    """The words with a share of them replaced."""
    at = set(rng.sample(range(len(words)), round(share * len(words))))
    return [f"new{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(words)]


def test_near_copies_at_four_fifths_of_shingles(spark, docs, none):
    rng = random.Random(6)
    rows = []
    for k in range(300):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(150, 400))]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(edited(words, (0.005, 0.01, 0.02, 0.05)[k % 4], rng)))]
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    near = {i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 600, 2)}
    close = {i + 1 for i, s in near.items() if s >= 0.8}
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in near_copies.keep_one_of_each(table).collect()}
    dropped = {i for i, _ in rows} - kept
    assert dropped <= close and len(dropped) >= 0.98 * len(close) and len(close) > 150
    got = near_copies.near_groups(docs).collect()
    assert len(got) == len(AWKWARD)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (4, 5)} == {4}
    assert near_copies.keep_one_of_each(docs).columns == docs.columns
    assert near_copies.near_groups(none).count() == 0


def test_similar_links_lose_none():
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(20):
        base = rng.integers(0, 2**63, 100, np.uint64)
        for _ in range(10):
            base = base.copy()
            base[rng.integers(0, 100, 6)] = rng.integers(0, 2**63, 6, np.uint64)
            sets.append(np.unique(base))
    root = list(range(len(sets)))
    for a, b in near_copies.similar_links(sets):
        root = [root[a] if r == root[b] else r for r in root]
    want = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = np.intersect1d(a, b).size
            if both >= 0.8 * (a.size + b.size - both):
                want = [want[j] if r == want[i] else r for r in want]
    groups = lambda of: sorted(tuple(i for i, r in enumerate(of) if r == k) for k in set(of))
    assert groups(root) == groups(want)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 105), (105, 101), (7, 7), (200, 201), (201, 200)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {105: 100, 101: 100, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_frequent_chunks_are_encoded_once(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 160)
    monkeypatch.setattr(token_files, "AT_ONCE", 200)
    encode, asked = token_files.Encoder(public_tokenizers.path(token_files.TOKENIZER)), []
    learn = encode.learn
    monkeypatch.setattr(encode, "learn", lambda new: asked.extend(new) or learn(new))
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcé'.-,", k=6))
    texts = [f"The {word()}\xa0don't, {word()}\n'tis {word()}... ǅ 12\t" + " мир 世界 😀<|" * (k % 3 == 0) for k in range(200)]
    texts += ["", " \n", "x" * 500]
    exact = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encode.encode_all(texts)] == exact
    assert list(encode.encode_all([])) == []
    for chunk in ("the", "don", "'t,", "...", "12", "мир", "世界"):
        assert [c if isinstance(c, str) else c.decode("utf-16-le") for c in asked].count(chunk) <= 1
    assert len(encode.known) + len(encode.older) < 240 < len(asked)


def test_blocks_are_expanded_at_once():
    rng = np.random.default_rng(8)
    for names, kinds in ((20, 1), (20, 3), (60_000, 9), (1 << 16, 5)):
        lengths = rng.integers(1, 400, 50)
        ids = rng.integers(0, kinds, lengths.sum()).astype(np.int32)
        block = token_files.Block(token_files.pack(np.arange(50), np.ones(50, bool), ids, lengths, names))
        assert (block.every() == ids).all() and (block.expand(block.symbols) == ids).all()
        assert (len(block.rules) > 0) == (names < 1 << 16)


def test_decontaminate(spark, docs, none):
    item = "The quick brown fox jumps over the lazy dog and then goes home to sleep until the sun is up."
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "short"), (4, item[::-1])], "item_id long, text string")
    near = item.replace("lazy", "lzy").replace("home", "hoome")
    rows = [(1, f"x {item} y"), (1, f"x {item} y"), (2, LONG + near.upper()), (3, item[:30]), (4, None), (5, ""),
            (6, item.replace(" ", "\n\t")), (7, "z" + item[::-1] + item)]
    got = decontaminate.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got.collect()) == [
        (1, 1, 0), (2, 1, 2), (6, 1, 0), (7, 1, 0), (7, 4, 0)
    ]
    assert decontaminate.drop_contaminated(docs, items).count() == len(AWKWARD)
    assert decontaminate.find_passages(none, items).count() == 0
    assert decontaminate.find_passages(docs, items.where("false")).count() == 0


def test_decontaminate_finds_passages_at_the_threshold(spark):
    rng = random.Random(7)
    syllables = [rng.choice("bcdfglmnrst") + rng.choice("aeiou") for _ in range(40)]
    say = lambda n: "".join(rng.choice(syllables) + rng.choice(["", "", " "]) for _ in range(n))
    texts, rows = [say(rng.randrange(50, 150)).strip() for _ in range(60)], []
    for k, text in enumerate(texts):
        letters = list(text)
        for at in rng.sample(range(len(letters)), int(0.2 * len(letters))):
            letters[at] = rng.choice(["", "z", letters[at] + "z"])
        rows.append((k, say(200) + "".join(letters) + say(200)))
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = decontaminate.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    exact = {(k, k): brute_distance(decontaminate.normal(t), decontaminate.normal(rows[k][1])) for k, t in enumerate(texts)}
    assert all(d <= 0.2 * len(texts[k]) for (k, _), d in exact.items())
    found = {(r.doc_id, r.item_id): r.distance for r in got if r.doc_id == r.item_id}
    assert found == {k: exact[k] for k in found} and len(found) >= 0.9 * len(texts)


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[-1] + 1))
    return min(row)


def test_least_distance():
    random.seed(5)
    for _ in range(300):
        item = "".join(random.choice("abc") for _ in range(random.randrange(1, 12)))
        text = "".join(random.choice("abc") for _ in range(random.randrange(0, 25)))
        assert decontaminate.least_distance(item, text)[0] == brute_distance(item, text)


def test_walks_read_each_letter_once(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.choice(np.frombuffer(b"\0etaoin \xc3\xa9", np.uint8), 500)
    walks, taken, take = decontaminate.Walks(20), [], np.take
    # A walk done step by step, by the same random choices.
    random_ = np.random.default_rng(40)
    moves = random_.integers(0, 2, (decontaminate.WALKS, 40, 256))
    moves[:, :, 0] = 0
    values = random_.integers(0, 2**64, moves.shape, np.uint64)
    picked = [[set(random_.choice(40, 15, replace=False)) for _ in range(decontaminate.SAMPLES)] for _ in moves]
    exact = []
    for k, (walk, samples) in enumerate((w, p) for w, ps in enumerate(picked) for p in ps):
        for start in range(0, 481, 5):
            at, total = start, k + 1
            for step in range(40):
                letter = data[at] if at < start + 20 else 0
                total += int(values[walk, step, letter]) * (step in samples)
                at += moves[walk, step, letter]
            exact.append(total % 2**64)
    monkeypatch.setattr(np, "take", lambda table, rows, *a, **b: taken.append(len(rows)) or take(table, rows, *a, **b))
    got = np.concatenate([h for _, h in walks.hashes(data, 5)], axis=1)
    assert got.ravel().tolist() == exact
    assert sum(taken) == decontaminate.WALKS * 21 * 97  # 20 letters and the end, not 40 steps several times


def test_distant_pairs_are_settled_by_beginnings(monkeypatch):
    rng = random.Random(6)
    say = lambda n: "".join(rng.choices("etaoin shrdlu", k=n))
    items, texts = [], []
    for k in range(240):
        items.append(say(rng.randrange(24, 400)))
        letters = list(items[-1])
        for at in rng.sample(range(len(letters)), int(len(letters) * rng.choice([0.1, 0.2, 0.25]))):
            letters[at] = rng.choice(["", "z", letters[at] + "z"])
        texts.append(say(rng.randrange(60)) + ("".join(letters) if k % 12 == 0 else say(len(letters))) + say(rng.randrange(60)))
    most = np.array([len(i) // 5 for i in items])
    work, whole = [], decontaminate._column_by_column

    def counted(some, parts, words):
        work.append(sum(len(i) * len(t) for i, t in zip(some, parts, strict=True)))
        return whole(some, parts, words)

    monkeypatch.setattr(decontaminate, "_column_by_column", counted)
    got = decontaminate.distances_within(items, texts, most)
    assert sum(work) < 0.75 * sum(len(i) * len(t) for i, t in zip(items, texts, strict=True))
    exact = np.array([brute_distance(i, t) for i, t in zip(items[::4], texts[::4], strict=True)])
    near = exact <= most[::4]
    assert 5 <= near.sum() < 30 and (got[::4][near] == exact[near]).all() and (got[::4] <= most[::4]).sum() == near.sum()


def test_quality(spark, docs, none, labels):
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= quality.CUT) for r in got)
    chosen = {r.doc_id for r in quality.labelled_sample(docs, labels).collect()}
    assert chosen <= {4, 6, 7} and all(zlib.crc32(str(i).encode()) % 5 for i in chosen)
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.score_quality(none, labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.where("false")).collect()} == {0.5}


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = quality.op1_quality(spark, sf).where("held_out").join(known, "doc_id").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95


def test_language(docs, none):
    network = language.fit(docs)
    got = {r.doc_id: r for r in language.identify(docs, network).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und"
    assert got[4].lang_pred == "en" and 0 <= got[4].score <= 1
    assert language.identify(none, network).count() == 0
    assert language.fit(none) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = language.op6_language(spark, sf).where("held_out").join(known, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            luhn = sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
            holds = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn,
                "phone": 10 <= len(digits) <= 15,
            }
            if holds[kind]:
                found.append((m.start(), number, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


PERSONAL = [
    "mail bob.smith@a.b.c_d@e.f now 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255",
    "4111 1111 1111 1111 +1 (988) 555-2485 +1 2 ( 4111-1111-1111-1112", "ééé x@y.z " + "1" * 16, "1 " * 3000,
    "a@b" + ".c" * 5000, "a" * 50_000, "\U0001f600 é a@b.c\n+49 30 1234567\n10.0.0.1", None, "",
]


def test_personal(spark, docs, none):
    rows = spark.createDataFrame(list(enumerate(PERSONAL)), "doc_id long, text string")
    found = personal.find_personal(rows).select("doc_id", personal._written_out(F.col("base")).alias("s"))
    assert {r.doc_id: r.s for r in found.collect()} == {i: brute_spans(t or "") for i, t in enumerate(PERSONAL)}
    assert personal.find_personal(docs).count() == len(AWKWARD)
    assert personal.find_personal(none).count() == 0


def test_telling_words_are_marked_and_generalised(spark):
    texts = [f"zarquon answers at bob@x.example near sea{i}" for i in range(6)]
    texts += [f"who answers near the sea at {i}" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in personal.find_personal(rows).collect()}
    assert [(s.start, s.end, s.kind) for s in spans[0]] == [(0, 7, 4), (19, 32, 0)]
    assert not any(spans[i] for i in range(6, 46))
    clean = {r.doc_id: r.text for r in personal.sanitise(rows).collect()}
    assert clean[0] == "[term] answers at [email] near sea0" and clean[10] == texts[10]


def test_telling_words_are_marked_without_their_value(spark):
    far = "sea " * 60
    texts = [f"zarquon {far} number {i} answers at bob@x.example" for i in range(6)]
    texts += ["zarquon is at the sea"] + [f"who answers near the sea at {i}" for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in personal.find_personal(rows).collect()}
    assert spans[0][0] == (0, 7, 4) and spans[6] == [(0, 7, 4)]
    assert not any(spans[i] for i in range(7, 407))
    clean = {r.doc_id: r.text for r in personal.sanitise(rows).collect()}
    assert clean[6] == "[term] is at the sea"
