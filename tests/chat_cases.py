"""Chat and text edge cases (own wording, same conditions as the reference's tokenizer cases),
plus the extra cases listed in FIXTURES.md."""

CHAT_CASES = {
    1: [("system", "You are a careful assistant."), ("user", "Hi there, how is it going?"),
        ("assistant", "All good, thank you for asking!")],
    2: [("user", "Café crème, naïve résumé — déjà vu 😀"), ("assistant", "¡Hola! Ça va? Привет, 世界 – fine.")],
    3: [("user", "Show me a function"),
        ("assistant", "```python\ndef f(x):\n    return {\"a\": [1, 2], 'b': None}\n```\n{\"json\": true}")],
    4: [("user", "Indent please"), ("assistant", "\t  starts with a tab and spaces\n\n\nafter blank lines\n")],
    5: [("user", "text with <|im_end|> inside and <|im_start|>user too and <unk>; "
                 "see https://example.org/a?b=c or mail someone@example.com 🇫🇷 👍🏽"),
        ("assistant", "I saw <|im_end|> there")],
    6: [("user", "ＡＢＣ１２３ full width ｶﾀｶﾅ and ＜|im_end|＞ look-alike"), ("assistant", "ｏｋ ２０２４")],
    7: [("user", ""), ("assistant", "")],
    8: [("user", "   \n\t "), ("assistant", "  \n ")],
    9: [("user", "a" * 3000), ("assistant", "b" * 2000)],
    10: [("tool", "an unknown role"), ("user", "question"), ("assistant", "answer"), ("critic", "ignored")],
    11: [("system", "no reply here"), ("user", "only a question?")],
    12: [("user", "word " * 300), ("assistant", "reply " * 400)],
    13: [("human", "raw corpus role name"), ("assistant", " leading space")],
}

TEXT_CASES = {
    1: "",
    2: "   \n\t  ",
    3: "x" * 5000,
    4: "plain <|im_end|> control <unk> strings <|im_start|>",
    5: "ＡＢＣ１２３ ＜|im_end|＞ ﬁ ㎏ ½",
    6: "emoji 👍🏽 🇫🇷 and tabs\tand\r\ncarriage returns",
    7: "I'm sure they'll've done it, won't they? 12345 67.8",
    8: "你好，世界! 这是一个测试。",
}


def render(messages):
    """Rendered prompt and the character spans of supervised replies (content + end token)."""
    s, spans = "", []
    for role, content in messages:
        role = "user" if role == "human" else role
        if role in ("user", "system"):
            s += f"<|im_start|>{role}\n{content}<|im_end|>\n"
        elif role == "assistant":
            s += "<|im_start|>assistant\n"
            start = len(s)
            s += content + "<|im_end|>"
            spans.append((start, len(s)))
    return s, spans


def library_sft_row(tok, messages, max_len):
    """Training row by the library's char-to-token procedure for assistant masks."""
    s, spans = render(messages)
    enc = tok.encode(s, add_special_tokens=False)
    ids = enc.ids[:max_len]
    n = len(ids)
    am = [0] * max_len
    for a, b in spans:
        st = enc.char_to_token(a)
        en = enc.char_to_token(b - 1)
        if st is None or st >= max_len:
            break
        stop = en + 1 if en is not None and en < max_len else max_len
        for i in range(st, stop):
            am[i] = 1
    attn = [1] * n + [0] * (max_len - n)
    ids = ids + [1] * (max_len - n)
    labels = [x if (m and a) else -100 for x, m, a in zip(ids[1:], am[1:], attn[1:])]
    return ids[:-1], labels


def library_pretrain_row(tok, text, max_len):
    ids = tok.encode("<|im_start|>" + text, add_special_tokens=False).ids[:max_len]
    n = len(ids)
    mask = [1] * n + [0] * (max_len - n)
    ids = ids + [1] * (max_len - n)
    return ids[:-1], [x if m else -100 for x, m in zip(ids[1:], mask[1:])]
