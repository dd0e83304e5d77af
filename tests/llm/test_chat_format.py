import hashlib
import random

import pytest

from conftest import rows
from tallyroute.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def brute(data):
    by_conv = {}
    for conv, turn, role, text in data:
        if conv is not None:
            key = (turn is not None, turn or 0, role or "", text or "")
            by_conv.setdefault(conv, []).append((key, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns = [t[1:] for t in sorted(turns)]
        said = "".join(t for r, t in turns if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(said),
                    hashlib.sha256(said.encode()).hexdigest(), len(C.chat_markup(turns))))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def test_what_is_read_back_is_what_went_in(spark):
    rng = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "assistant\n", "\\", "<|", "<\\|", "\n", "é😀", "x", "y", ""]
    data = [(c, t, rng.choice(["user", "assistant", "system", "a\nb\\n<|"]),
             "".join(rng.choice(bits) for _ in range(rng.randint(0, 8))))
            for c in range(60) for t in range(rng.randint(1, 6))]
    data += [(70, 0, "user", None), (70, 1, None, "no role"), (70, None, "assistant", "no turn"),
             (None, 1, "user", "lost"), (71, 0, "user", "same"), (71, 0, "user", "same"),
             (71, 0, "assistant", "same turn"), (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
             (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (72, 0, "assistant", "z" * 200_000)]
    df = spark.createDataFrame([(*r, "f") for r in data], SCHEMA)
    assert rows(C.digest(C.format_conversations(df))) == brute(data)
    assert C.format_conversations(df.limit(0)).count() == 0


TURNS = [("system", "be brief"), ("user", "x"), ("assistant", "xy"), ("user", ""), ("assistant", "y")]


def test_spans_of_the_default_template():
    formatted, spans, rewritten = C.locate(C.chat_markup, TURNS)
    assert formatted == C.chat_markup(TURNS) and rewritten is None
    assert [formatted[s.text_start:s.text_end] for s in spans] == [t for _, t in TURNS]
    assert "".join(formatted[s.start:s.end] for s in spans) == formatted


def test_templates_that_rewrite_history_are_found():
    def latest_only(turns):
        """Earlier assistant texts are shortened once the user speaks again."""
        last = max((k for k, (r, _) in enumerate(turns) if r == "user"), default=0)
        return "".join(f"[{r}]{t[:1] if r == 'assistant' and k < last else t}[/]"
                       for k, (r, t) in enumerate(turns))

    formatted, spans, rewritten = C.locate(latest_only, TURNS)
    assert rewritten == 3 and formatted == latest_only(TURNS)
    assert [formatted[s.text_start:s.text_end] for s in spans][1] == "x"
    assert formatted[spans[4].text_start:spans[4].text_end] == "y"


@pytest.mark.parametrize("turns", [[], [("user", "")]])
def test_short_conversations(turns):
    formatted, spans, rewritten = C.locate(C.chat_markup, turns)
    assert formatted == C.chat_markup(turns) and len(spans) == len(turns) and rewritten is None
