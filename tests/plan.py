from __future__ import annotations

import contextlib
import io


def plan(df) -> str:
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()
