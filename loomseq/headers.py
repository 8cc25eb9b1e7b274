"""Driver-side header objects of alignment and variant files. Headers are small; records never come here."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the formats: line kinds and the numeric fields of each.
SAM_KINDS = ("HD", "SQ", "RG", "PG", "CO")
SAM_INTEGERS = {"SQ": {"LN"}, "RG": {"PI"}}


class AlignmentHeader:
    """@HD, @SQ, @RG, @PG and @CO records in order."""

    def __init__(self, records: dict | None = None):
        self.records: dict = records or {}

    @classmethod
    def from_text(cls, text: str) -> AlignmentHeader:
        records: dict = {}
        for line in text.splitlines():
            if not line.startswith("@"):
                continue
            kind, _, rest = line[1:].partition("\t")
            if kind == "CO":
                records.setdefault("CO", []).append(rest)
                continue
            fields: dict = {}
            for part in filter(None, rest.split("\t")):
                key, colon, value = part.partition(":")
                if not colon:
                    raise ValueError(f"malformed header field {part!r}")
                fields[key] = int(value) if key in SAM_INTEGERS.get(kind, ()) else value
            if kind == "HD":
                records["HD"] = fields
            else:
                records.setdefault(kind, []).append(fields)
        return cls(records)

    @classmethod
    def from_dict(cls, records: dict) -> AlignmentHeader:
        unknown = [k for k in records if k not in SAM_KINDS and not k.islower()]
        if unknown:
            raise ValueError(f"unknown header kinds {unknown}")
        return cls({k: dict(v) if isinstance(v, dict) else list(v) for k, v in records.items()})

    @classmethod
    def from_references(cls, names: list[str], lengths: list[int]) -> AlignmentHeader:
        if len(names) != len(lengths):
            raise ValueError("names and lengths differ in number")
        return cls({"SQ": [{"SN": n, "LN": int(m)} for n, m in zip(names, lengths)]})

    def to_dict(self) -> dict:
        return {k: dict(v) if isinstance(v, dict) else list(v) for k, v in self.records.items()}

    def copy(self) -> AlignmentHeader:
        return AlignmentHeader.from_dict(self.to_dict())

    def __str__(self) -> str:
        lines = []
        for kind in [*SAM_KINDS, *(k for k in self.records if k not in SAM_KINDS)]:
            got = self.records.get(kind, [])
            for record in [got] if isinstance(got, dict) else got:
                lines.append(f"@{kind}\t{record}" if isinstance(record, str) else "\t".join([f"@{kind}", *(f"{k}:{v}" for k, v in record.items())]))
        return "".join(f"{line}\n" for line in lines)

    text = property(__str__)

    @property
    def references(self) -> tuple[str, ...]:
        return tuple(r["SN"] for r in self.records.get("SQ", []))

    @property
    def lengths(self) -> tuple[int, ...]:
        return tuple(r["LN"] for r in self.records.get("SQ", []))

    @property
    def nreferences(self) -> int:
        return len(self.references)

    def is_valid_tid(self, tid: int) -> bool:
        return 0 <= tid < self.nreferences

    def get_tid(self, name: str) -> int:
        return self.references.index(name) if name in self.references else -1

    def get_reference_name(self, tid: int) -> str:
        if tid == -1:
            return "*"
        if not self.is_valid_tid(tid):
            raise ValueError(f"reference number {tid} out of range")
        return self.references[tid]

    def get_reference_length(self, name: str) -> int:
        if name not in self.references:
            raise KeyError(name)
        return self.lengths[self.references.index(name)]

    def contigs(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, m) for i, (n, m) in enumerate(zip(self.references, self.lengths))]
        return spark.createDataFrame(rows, "tid int, name string, length bigint")

    def read_groups(self, spark: SparkSession) -> DataFrame:
        rows = [(r.get("ID"), r.get("SM"), r.get("LB"), r.get("PL"), r.get("PU"), r.get("CN")) for r in self.records.get("RG", [])]
        return spark.createDataFrame(rows, "id string, sample string, library string, platform string, unit string, center string")

    def programs(self, spark: SparkSession) -> DataFrame:
        rows = [(r.get("ID"), r.get("PN"), r.get("VN"), r.get("CL"), r.get("PP")) for r in self.records.get("PG", [])]
        return spark.createDataFrame(rows, "id string, name string, version string, command string, previous string")


@dataclass
class Field:
    """An INFO or FORMAT declaration."""

    name: str
    number: str
    type: str
    description: str = ""

    @property
    def scalar(self) -> bool:
        return self.number == "1"

    @property
    def ddl(self) -> str:
        base = {"Integer": "bigint", "Float": "double", "Flag": "boolean"}.get(self.type, "string")
        return base if self.scalar or self.type == "Flag" else f"array<{base}>"


@dataclass
class VariantHeader:
    """## lines of a variant file and its samples."""

    version: str = "VCFv4.2"
    info: dict[str, Field] = field(default_factory=dict)
    formats: dict[str, Field] = field(default_factory=dict)
    filters: dict[str, str] = field(default_factory=lambda: {"PASS": "All filters passed"})
    contigs: dict[str, int | None] = field(default_factory=dict)
    samples: list[str] = field(default_factory=list)
    other: list[tuple[str, str]] = field(default_factory=list)

    @classmethod
    def from_text(cls, text: str) -> VariantHeader:
        header = cls()
        for line in text.splitlines():
            header.add_line(line)
        return header

    def add_line(self, line: str) -> None:
        if line.startswith("#CHROM"):
            self.samples = line.rstrip("\n").split("\t")[9:]
            if len(set(self.samples)) < len(self.samples):
                raise ValueError("duplicate sample names")
            return
        if not line.startswith("##"):
            return
        key, _, value = line[2:].partition("=")
        if key == "fileformat":
            self.version = value
        elif value.startswith("<") and value.endswith(">"):
            self.add_record(key, _attributes(value[1:-1]))
        else:
            self.other.append((key, value))

    def add_record(self, key: str, attributes: dict[str, str]) -> None:
        name = attributes.get("ID", "")
        if key in ("INFO", "FORMAT"):
            (self.info if key == "INFO" else self.formats)[name] = Field(name, attributes.get("Number", "."), attributes.get("Type", "String"), attributes.get("Description", ""))
        elif key == "FILTER":
            self.filters[name] = attributes.get("Description", "")
        elif key == "contig":
            self.contigs[name] = int(attributes["length"]) if attributes.get("length", "").isdigit() else None
        else:
            self.other.append((key, "<" + ",".join(f"{k}={v}" for k, v in attributes.items()) + ">"))

    def add_meta(self, key: str, value: str | None = None, items: list[tuple[str, str]] | None = None) -> None:
        if items is not None:
            self.add_record(key, dict(items))
        else:
            self.other.append((key, value or ""))

    def add_sample(self, name: str) -> None:
        if name in self.samples:
            raise ValueError(f"sample {name!r} is there already")
        self.samples.append(name)

    def merge(self, other: VariantHeader) -> VariantHeader:
        """Declarations of both; the first wins where both have one."""
        out = VariantHeader(self.version)
        for name in ("info", "formats", "filters", "contigs"):
            setattr(out, name, getattr(other, name) | getattr(self, name))
        out.contigs = {k: out.contigs[k] for k in [*self.contigs, *(c for c in other.contigs if c not in self.contigs)]}
        out.samples = [*self.samples, *(s for s in other.samples if s not in self.samples)]
        out.other = [*self.other, *(o for o in other.other if o not in self.other)]
        return out

    def copy(self) -> VariantHeader:
        return VariantHeader.from_text(str(self))

    def __str__(self) -> str:
        lines = [f"##fileformat={self.version}", *(f'##FILTER=<ID={k},Description="{v}">' for k, v in self.filters.items())]
        lines += [f"##{k}={v}" for k, v in self.other]
        for kind, fields in (("INFO", self.info), ("FORMAT", self.formats)):
            lines += [f'##{kind}=<ID={f.name},Number={f.number},Type={f.type},Description="{f.description}">' for f in fields.values()]
        lines += [f"##contig=<ID={k}{'' if v is None else f',length={v}'}>" for k, v in self.contigs.items()]
        columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *self.samples] if self.samples else [])]
        return "".join(f"{line}\n" for line in [*lines, "\t".join(columns)])


def _attributes(text: str) -> dict[str, str]:
    """``ID=x,Description="a, b"`` as a mapping; quotes are taken off."""
    out = {}
    for m in re.finditer(r'([^=,]+)=("(?:\\.|[^"\\])*"|[^,]*),?', text):
        value = m[2]
        out[m[1].strip()] = re.sub(r"\\(.)", r"\1", value[1:-1]) if value[:1] == '"' else value
    return out
