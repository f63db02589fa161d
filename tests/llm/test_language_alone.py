"""The language of a text depends on the text alone."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("indipanel.llm")

from indipanel.llm import language  # noqa: E402


def test_neighbours_do_not_matter():
    rng = np.random.default_rng(13)
    model = language.Model(["a", "b", "c"], np.log(rng.random((language.SLOTS, 3))).astype(np.float32))
    for text in ("house", "le", "été", " two words ", "x"):
        alone = language.shares_of(model, pa.array([text]))[0]
        for other in ("zebra", "  \n\t far", "", None, "é"):
            np.testing.assert_array_equal(language.shares_of(model, pa.array([other, text, other, text, other]))[[1, 3]], [alone, alone])
