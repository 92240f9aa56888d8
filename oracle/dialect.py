"""Small SQL builders and the assembly of WITH clauses."""

from __future__ import annotations

import re
import zlib


def rnd(x: str, digits: int) -> str:
    return f"(floor(({x})*{10**digits}.0+0.5)/{10**digits}.0)"


def fixed(x: str, digits: int = 2) -> str:
    return f"CAST(floor(({x})*{10**digits}+0.5) AS BIGINT)"


def msum(x: str) -> str:
    return f"(sum({fixed(x)})::DOUBLE/100)"


def mavg(x: str) -> str:
    return f"({msum(x)}/count({x}))"


def favg(x: str, digits: int = 4) -> str:
    return f"(sum({fixed(x, digits)})::DOUBLE/{10**digits}/count({x}))"


def iavg(x: str) -> str:
    return f"(sum({x})::DOUBLE/nullif(count({x}),0))"


def rat(a: str, b: str) -> str:
    return f"(({a})::DOUBLE/nullif(({b})::DOUBLE,0))"


def pct(a: str, b: str) -> str:
    return f"({rat(a, b)}*100)"


def change(now: str, before: str) -> str:
    return f"((({now})::DOUBLE-({before}))/nullif(({before})::DOUBLE,0)*100)"


def draw(key: str, salt: str) -> str:
    p, q = PRIMES
    x = f"((({key})::BIGINT%{p}*48271+{zlib.crc32(salt.encode())})%{p})"
    return f"({x}*1226874159%{q}*742938285%{p})"


def chosen(key: str, salt: str, rate: float) -> str:
    return f"({draw(key, salt)}<{int(rate * 2147483647)})"


def drawn(key: str, salt: str, low: float, high: float) -> str:
    return f"({chosen(key, salt, high)} AND NOT {chosen(key, salt, low)})"


def number(key: str, salt: str) -> str:
    return f"({draw(key, salt)}*16807%2147483647)"


def bucket(key: str, salt: str, n: int) -> str:
    return f"({number(key, salt)}%{n})"


def hash60(*cols: str) -> str:
    return "(('0x'||substr(md5(" + "||'|'||".join(cols) + "),1,15))::BIGINT)"


PRIMES = (2147483647, 2147483629)
SPREAD = (
    (48271, 69621, 630360016, 742938285, 950706376, 1226874159),
    (16807, 39373, 764261123, 1078318381, 397204094, 62089911),
)


def number_key(*cols: str) -> str:
    halves = [
        "((" + "+".join(f"(({c})::BIGINT%{p}*{m}%{p})" for c, m in zip(cols, spread)) + f")%{p})"
        for p, spread in zip(PRIMES, SPREAD)
    ]
    return f"({halves[0]}*2147483648+{halves[1]})"


def month(d: str) -> str:
    return f"strftime({d},'%Y-%m')"


def year(d: str) -> str:
    return f"year({d})::INT"


def qtr(d: str) -> str:
    return f"('Q'||quarter({d}))"


def yq(d: str) -> str:
    return f"(year({d})||'-Q'||quarter({d}))"


def replaces(x: str, pairs: list[tuple[str, str]]) -> str:
    for good, bad in pairs:
        x = f"replace({x},'{good}','{bad}')"
    return x


def with_tables(body: str, tables: dict[str, str]) -> str:
    """Prefix ``body`` with the table definitions it needs, in order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\b(?:b|d|v|dv|x)_[a-z0-9_]+\b", text)):
            if name in tables and name not in needed:
                visit(tables[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({tables[n]})" for n in needed) + "\n" + body
