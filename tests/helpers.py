import contextlib
import io


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def values(df, column):
    return [r[column] for r in df.collect()]
