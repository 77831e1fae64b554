"""Write API.md: public functions of the package with signature and first docstring paragraph."""

from __future__ import annotations

import importlib
import inspect
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

MODULES = [
    "fleetscope.session", "fleetscope.schema",
    "fleetscope.sources.fixture", "fleetscope.sources.files", "fleetscope.sources.ingest",
    "fleetscope.functions.expr",
    "fleetscope.operators.dedup", "fleetscope.operators.lag", "fleetscope.operators.aggregate",
    "fleetscope.operators.cleanse", "fleetscope.operators.lookup", "fleetscope.operators.where",
    "fleetscope.plans.reports", "fleetscope.plans.sql_reports", "fleetscope.plans.mart",
    "fleetscope.plans.manifest", "fleetscope.streaming.ingest",
]


def first_paragraph(doc: str | None) -> str:
    if not doc:
        return ""
    return " ".join(inspect.cleandoc(doc).split("\n\n")[0].split())


def main() -> None:
    out = ["# API — public functions of `fleetscope`", "",
           "Generated by `python scripts/api_doc.py`. Every function returns a lazy DataFrame or Column "
           "unless it is a sink or a job.", ""]
    for name in MODULES:
        mod = importlib.import_module(name)
        funcs = [(n, f) for n, f in inspect.getmembers(mod, inspect.isfunction)
                 if f.__module__ == name and not n.startswith("_")]
        if not funcs:
            continue
        out += [f"## `{name}`", "", first_paragraph(mod.__doc__), ""]
        for n, f in sorted(funcs, key=lambda x: inspect.getsourcelines(x[1])[1]):
            sig = str(inspect.signature(f)).replace("'", "")
            out += [f"* **`{n}{sig}`**  ", f"  {first_paragraph(f.__doc__)}"]
        out.append("")
    with open(os.path.join(ROOT, "API.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
