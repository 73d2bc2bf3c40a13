"""Languages: the registry file, the chain of label languages, the append-only id table, and the parsers of index pages."""

from __future__ import annotations

import datetime
import hashlib
import json
import re
import shutil
import time
import urllib.error
import urllib.request
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PROJECTS = ("wikipedia", "wiktionary", "dbpedia")
#: Label kinds that are no languages.
PSEUDO = ("mul", "doi", "best")


def languages(registry: dict, project: str, override: dict | None = None) -> list[str]:
    """Codes of a project, in the registry's order, kept to the override's list where there is one."""
    if project not in PROJECTS:
        raise ValueError(f"unknown project {project}")
    kept = (override or {}).get(project)
    return [c for c in registry[project] if kept is None or c in kept]


def load(path: str, project: str, override_path: str | None = None) -> list[str]:
    override = json.loads(Path(override_path).read_text()) if override_path and Path(override_path).exists() else None
    return languages(json.loads(Path(path).read_text()), project, override)


def label_chain(registry: dict, override: dict | None = None) -> list[str]:
    return [*languages(registry, "wikipedia", override), *registry.get("wikipedia_no_export", []), *PSEUDO]


def with_new_codes(known: DataFrame, codes: DataFrame) -> DataFrame:
    """known (id, code) and rows for codes it lacks, numbered on from its largest id in code order. Ids never change; one writer at a time.

    The numbering sorts codes of one dimension, some hundreds of rows."""
    new = codes.select("code").where("code IS NOT NULL").distinct().join(known, "code", "left_anti")
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    numbered = new.crossJoin(F.broadcast(last)).select((F.col("last") + F.row_number().over(W.orderBy("code"))).cast("smallint").alias("id"), "code")
    return known.select(F.col("id").cast("smallint").alias("id"), "code").unionByName(numbered)


def is_language_code(code: str) -> bool:
    return re.fullmatch(r"simple|[a-z]{2,3}(-[a-z]+)*", code) is not None


def wiki_ids(page: str) -> list[str]:
    return sorted(set(re.findall(r'href="([a-z0-9_\-]+)/"', page)))


def with_suffix(ids: list[str], suffix: str) -> list[str]:
    return sorted(c for i in ids if i.endswith(suffix) and is_language_code(c := i.removesuffix(suffix)))


def export_dates(page: str) -> list[str]:
    """Newest first."""
    return sorted(set(re.findall(r'href="(\d{4}-\d{2}-\d{2}|\d{8})/"', page)), reverse=True)


def resource_languages(page: str) -> list[str]:
    return sorted(set(re.findall(r"lang(?:%3D|=)([a-z\-]+)", page)))


def title_url(base: str, title: str) -> str:
    return f"{base.rstrip('/')}/{quote(title.replace(' ', '_'), safe='')}"


def fetch(url: str, tries: int = 3, wait_s: float = 1.0) -> str | None:
    """Text of a page; null where there is none (404). Any other failure is raised after the last try."""
    for k in range(tries):
        try:
            with urllib.request.urlopen(url, timeout=60) as r:
                return r.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if k == tries - 1:
                raise
        except OSError:
            if k == tries - 1:
                raise
        time.sleep(wait_s)
    return None


def manifest(text: str) -> dict[str, str]:
    """Checksum lines (`sum  name`) as name -> sum."""
    return {name.strip().lstrip("*"): digest for digest, _, name in (line.partition(" ") for line in text.splitlines()) if name.strip()}


def discovered(index: str, fetch_page=fetch, resources: str | None = None) -> dict:
    """Registry made from index pages below `index`, and from the page `resources` that lists resource languages; a failing probe stops it rather
    than losing a language, as does a list without any."""
    ids = wiki_ids(fetch_page(index) or "")
    found = {"wikipedia": with_suffix(ids, "wiki"), "wiktionary": with_suffix(ids, "wiktionary")}
    exported = {k: [c for c in v if export_dates(fetch_page(f"{index}/{c}{'wiki' if k == 'wikipedia' else 'wiktionary'}/") or "")] for k, v in found.items()}
    listed = resource_languages(fetch_page(resources) or "") if resources else []
    if not ids or (resources and not listed):
        raise ValueError(f"no languages listed at {resources if ids else index}")
    return exported | {"wikipedia_no_export": [c for c in found["wikipedia"] if c not in exported["wikipedia"]], "dbpedia": listed}


def fetch_file(url: str, path: Path) -> None:
    with urllib.request.urlopen(url, timeout=600) as r, open(path, "wb") as f:
        shutil.copyfileobj(r, f)


def _sha256(path: Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def download(index: str, wiki: str, folder: str, fetch_page=fetch, fetch_to=fetch_file, prune: bool = True) -> list[str]:
    """Paths of all files of the newest complete export of a wiki: those with a list of checksums. Files that are there and whole are not fetched
    again; one whose sum differs is removed and an error. Folders of other dates go, once all is well."""
    for date in export_dates(fetch_page(f"{index}/{wiki}/") or ""):
        base = f"{index}/{wiki}/{date}"
        if (sums := fetch_page(f"{base}/SHA256SUMS")) is not None:
            break
    else:
        raise FileNotFoundError(f"{wiki} has no complete export")
    own = Path(folder) / wiki / date
    own.mkdir(parents=True, exist_ok=True)
    wanted = manifest(sums)
    for name, digest in wanted.items():
        path, part = own / name, own / f".{name}.part"
        if path.exists() and _sha256(path) == digest:
            continue
        fetch_to(f"{base}/{name}", part)
        if _sha256(part) != digest:
            part.unlink()
            raise ValueError(f"{name}: the checksum differs")
        part.replace(path)
    for other in (Path(folder) / wiki).iterdir() if prune else ():
        if other.is_dir() and other != own and re.fullmatch(r"\d{4}-\d{2}-\d{2}|\d{8}", other.name):
            shutil.rmtree(other)
    return sorted(str(own / name) for name in wanted)


def featured_url(base: str, lang: str, day: datetime.date) -> str:
    """Where the feed of a day's featured pages lies; fetch() gets it, pretty() shows it."""
    return f"{base.rstrip('/')}/{lang}/featured/{day:%Y/%m/%d}"


def pretty(registry: dict) -> str:
    return json.dumps(registry, indent=2, ensure_ascii=False)
