"""Long unsplit text in any script goes through tree concatenation and equals the library."""

import random

from bylinelake.llm import bpe


def test_unsplit_runs_of_all_scripts(tokenizer, monkeypatch):
    enc = bpe.WordBpe(tokenizer)
    joined = []
    own = enc.join_leaves
    monkeypatch.setattr(enc, "join_leaves", lambda s: joined.append(s) or own(s))
    g = random.Random(3)
    han = "".join(chr(g.randrange(0x4E00, 0x9FA5)) for _ in range(900))
    kana = "".join(g.choice("あいうえおかきくけこアイウエオー") for _ in range(400))
    latin = "".join(g.choice("abcdetnoris") for _ in range(700))
    mixed = [f"{han} and {latin}", kana, f"“{latin}”—{han}…", f"ÉCOLE {latin.upper()} é{latin}", "Ω" * 300, f"{han[:40]}123{kana[:30]}!!{latin[:50]}", "é" * 60 + "​" + han[:30], "힣" * 77, "a\x1cb" + han[:20]]
    for text in mixed:
        before = len(joined)
        assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids, text[:40]
        assert len(joined) > before


def test_random_mixtures(tokenizer):
    enc, g = bpe.WordBpe(tokenizer, long_word=6, leaf=3), random.Random(4)
    parts = ["the", "x" * 9, "été", "漢字仮名", "ñandú", " ", "\n", "!?", "2024", "'s", "Straße", "İ", "ﬁ", "😀😀", "’", " ", "\t"]
    for _ in range(400):
        text = "".join(g.choice(parts) for _ in range(g.randrange(30)))
        assert enc.encode(text).tolist() == enc.library.encode(text, add_special_tokens=False).ids, repr(text)
