"""Secrets in assignments."""

import random
import string

from geopulse.llm import secrets


def test_secrets_in_assignments():
    """The value of NAME=VALUE is tested by itself."""
    draw = random.Random(11)
    made = ["".join(draw.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(200)]
    for name in ("AWS_ACCESS_VALUE=", "https://host.example/x?sig=", "PRIVATE_KEY="):
        hit = 0
        for m in made:
            text = f"export {name}{m}= end"
            at = text.index(m)
            hit += (at, 3, at + len(m) + 1) in secrets.find(text)
        assert hit > 0.85 * len(made)
        assert hit == sum((3, 3, 44) in secrets.find(f"a: {m}=") for m in made)
