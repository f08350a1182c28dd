"""Conversion backends: a registry of Arrow functions over binary files; absent libraries are reported, not faked."""

from __future__ import annotations

import importlib.util
import signal
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

RESULT = "path string, body string, n_pages int, n_chars int, converter string, fell_back boolean, error string"
LIBRARIES = {"pymupdf": "pymupdf", "pdfplumber": "pdfplumber", "docling": "docling", "opendataloader": "opendataloader_pdf", "lightonocr": "vllm", "markitdown": "markitdown"}
_backends: dict[str, Callable[[], Callable[[bytes], tuple[str, int]]]] = {}


def register(name: str, make: Callable[[], Callable[[bytes], tuple[str, int]]]) -> None:
    """Add a backend: make() is called once a Python worker and gives a function from bytes to (markdown, pages)."""
    _backends[name] = make


def _plain() -> Callable[[bytes], tuple[str, int]]:
    return lambda raw: ((t := raw.decode("utf-8", "replace")).replace("\f", "\n"), t.count("\f") + 1)


def _pymupdf() -> Callable[[bytes], tuple[str, int]]:
    import pymupdf

    def run(raw: bytes) -> tuple[str, int]:
        with pymupdf.open(stream=raw, filetype="pdf") as doc:
            return "\n\n".join(page.get_text("text") for page in doc), doc.page_count

    return run


def _pdfplumber() -> Callable[[bytes], tuple[str, int]]:
    import io

    import pdfplumber

    def run(raw: bytes) -> tuple[str, int]:
        with pdfplumber.open(io.BytesIO(raw)) as doc:
            return "\n\n".join(p.extract_text() or "" for p in doc.pages), len(doc.pages)

    return run


def _markitdown() -> Callable[[bytes], tuple[str, int]]:
    import io

    from markitdown import MarkItDown

    convert = MarkItDown()
    return lambda raw: (convert.convert_stream(io.BytesIO(raw), file_extension=".pdf").text_content, 0)


register("plain", _plain)
register("pymupdf", _pymupdf)
register("pdfplumber", _pdfplumber)
register("markitdown", _markitdown)


def available() -> list[str]:
    return [n for n in sorted(_backends) if importlib.util.find_spec(LIBRARIES.get(n, "json"))]


def backend(name: str) -> Callable[[], Callable[[bytes], tuple[str, int]]]:
    if name not in _backends:
        raise ValueError(f"unknown converter {name!r}; options: {', '.join(sorted(_backends))}")
    return _backends[name]


class _Deadline:
    """Raises in the worker's main thread after some seconds, again and again until left."""

    def __init__(self, seconds: float):
        self.seconds = seconds

    def __enter__(self) -> None:
        def late(*_: object) -> None:
            raise TimeoutError(f"no result in {self.seconds:g} s")

        self.old = signal.signal(signal.SIGALRM, late)
        signal.setitimer(signal.ITIMER_REAL, self.seconds, 5.0)

    def __exit__(self, *_: object) -> None:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, self.old)


def convert(files: DataFrame, chain: list[str], seconds: float = 300.0) -> DataFrame:
    """(path, content) files through a chain of backends: the first that gives text is taken.

    Each worker keeps one instance of a backend and drops it after a time-out. Failures are rows with an error.
    """
    makers = {n: backend(n) for n in chain}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        live: dict[str, Callable[[bytes], tuple[str, int]]] = {}
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                errors: list[str] = []
                row = (path, None, None, None, None, None, None)
                for at, name in enumerate(chain):
                    try:
                        if name not in live:
                            live[name] = makers[name]()
                        with _Deadline(seconds):
                            body, pages = live[name](bytes(content))
                        row = (path, body, pages, len(body), name, at > 0, "; ".join(errors) or None)
                        break
                    except Exception as e:  # a backend may fail in any way; the row tells how
                        if isinstance(e, TimeoutError):
                            live.pop(name, None)
                        errors.append(f"{name}: {type(e).__name__}: {e}")
                else:
                    row = (path, None, None, None, None, None, "; ".join(errors))
                out.append(row)
            yield pd.DataFrame(out, columns=["path", "body", "n_pages", "n_chars", "converter", "fell_back", "error"]).astype({"n_pages": "Int32", "n_chars": "Int32", "fell_back": "boolean"})

    return files.select("path", "content").mapInPandas(run, RESULT)
