"""Strings that the token test of the secret scan reports."""
import base64
import random
import string

import pytest

from starloom.llm import secret_scan
from starloom.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def found():
    enc = secret_scan.encoding(tokenizer_path("byte_bpe_50k.tiktoken"))

    def spans(text):
        taken = secret_scan.base_spans(text)
        return [text[a:b] for a, _, b in secret_scan.random_spans(text, enc, taken)]
    return spans


def test_random_strings_are_found_whole(found):
    rng = random.Random(5)
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    assert found(f"aws_secret_access_key = {key}") == found(f"aws_secret_access_key={key}") == [key]
    assert found("https://x.com/files/uploads/Zx8Qp2Lm9Vt4Kw7R/index") == ["Zx8Qp2Lm9Vt4Kw7R"]
    kinds = {
        "base64": lambda: base64.b64encode(rng.randbytes(30)).decode(),
        "padded": lambda: base64.b64encode(rng.randbytes(31)).decode(),
        "short": lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=16)),
        "letters": lambda: "".join(rng.choices(string.ascii_letters, k=32)),
    }
    for make in kinds.values():
        made = [make() for _ in range(1000)]
        assert sum(found(f"see {s} there") == [s] for s in made) >= 990


def test_paths_words_and_identifiers_are_not(found):
    for text in ("/usr/lib/python3/dist-packages/numpy/core/multiarray", "he/she/they/it/we/I/you/us", "=" * 20,
                 "getElementsByClassName", "2020/10/12/11/22/33/44/55", "=-=-=-=-=-=-=-=-=-=", "internationalization",
                 "item/123e4567-e89b-12d3-a456-426614174000/123e4567-e89b-12d3-a456-426614174001"):
        assert found(text) == []
