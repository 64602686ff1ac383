"""Powers are kept for what was asked for, not for the largest slice."""

import numpy as np

from marquee.llm import textbytes


def test_powers_grow_with_what_is_asked():
    powers = textbytes.Powers(0x9E3779B97F4A7C15)
    up, down = powers.upto(1000)
    assert len(powers.up) == 1000
    assert (up * down == np.uint64(1)).all()
    again, _ = powers.upto(1500)
    assert len(powers.up) == 2000 and (again[:1000] == up).all()
