"""Archives: the text of a result archive, and skill folders as validated archives."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def archive_text(content: bytes | None) -> str | None:
    """``full.md`` of an archive, else its first Markdown file; None where there is none or the archive is broken."""
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
            names = [n for n in z.namelist() if n.endswith(".md")]
            pick = next((n for n in names if n.rsplit("/", 1)[-1] == "full.md"), names[0] if names else None)
            return z.read(pick).decode("utf-8", "replace") if pick else None
    except zipfile.BadZipFile:
        return None


def archive_texts(content: Column) -> Column:
    @F.arrow_udf("string")
    def read(content: pa.Array) -> pa.Array:
        return pa.array([archive_text(c) for c in content.to_pylist()], pa.string())

    return read(content)


def new_skill(name: str, folder: str) -> Path:
    """A skill folder with a front matter to fill in."""
    root = Path(folder) / name
    (root / "scripts").mkdir(parents=True)
    (root / "references").mkdir()
    title = " ".join(w.capitalize() for w in name.split("-"))
    (root / "SKILL.md").write_text(f"---\nname: {name}\ndescription: What the skill does and when to use it.\n---\n\n# {title}\n", encoding="utf-8")
    return root


def packed_skill(folder: str, target: str | None = None) -> Path:
    """A skill folder as ``<name>.skill``; an invalid front matter is an error."""
    root = Path(folder)
    text = (root / "SKILL.md").read_text(encoding="utf-8")
    lines = text.split("\n---", 1)[0].split("\n")[1:] if text.startswith("---\n") and "\n---" in text[3:] else None
    keys = {x.split(":", 1)[0].strip() for x in lines or [] if ":" in x}
    if lines is None or not {"name", "description"} <= keys:
        raise ValueError(f"{root}: front matter with name and description is required")
    out = Path(target or root.parent) / f"{root.name}.skill"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*")):
            if p.is_file():
                z.write(p, p.relative_to(root.parent))
    return out
