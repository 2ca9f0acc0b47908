"""Ed25519 signatures (RFC 8032) in plain Python, so that executors can sign and verify without a further library.

A signature takes some milliseconds; a ledger has one for each batch of events. Keys are kept as the usual PEM files.
Not hardened against timing: sign where no one else can measure.
"""

from __future__ import annotations

import base64
import hashlib
import os

#: Fixed values of the curve, and what precedes the 32 bytes of a key in its PEM file (RFC 8410).
P = 2**255 - 19
ORDER = 2**252 + 27742317777372353535851937790883648493
D = -121665 * pow(121666, -1, P) % P
ROOT = pow(2, (P - 1) // 4, P)
PRIVATE_HEAD, PUBLIC_HEAD = bytes.fromhex("302e020100300506032b657004220420"), bytes.fromhex("302a300506032b6570032100")

Point = tuple[int, int, int, int]


def _add(a: Point, b: Point) -> Point:
    """Sum of two points in extended coordinates (x, y, z, xy/z)."""
    minus, plus = (a[1] - a[0]) * (b[1] - b[0]) % P, (a[1] + a[0]) * (b[1] + b[0]) % P
    t, z = 2 * a[3] * b[3] * D % P, 2 * a[2] * b[2] % P
    e, f, g, h = plus - minus, z - t, z + t, plus + minus
    return e * f % P, g * h % P, f * g % P, e * h % P


def _times(n: int, point: Point) -> Point:
    out = (0, 1, 1, 0)
    while n:
        if n & 1:
            out = _add(out, point)
        point, n = _add(point, point), n >> 1
    return out


def _x_of(y: int, odd: int) -> int | None:
    """The x with that parity of a curve point, None if there is none."""
    square = (y * y - 1) * pow(D * y * y + 1, -1, P) % P
    x = pow(square, (P + 3) // 8, P)
    if (x * x - square) % P:
        x = x * ROOT % P
    if (x * x - square) % P or (x == 0 and odd):
        return None
    return P - x if x % 2 != odd else x


_Y = 4 * pow(5, -1, P) % P
_X = _x_of(_Y, 0)
BASE: Point = (_X, _Y, 1, _X * _Y % P)


def _packed(point: Point) -> bytes:
    inverse = pow(point[2], -1, P)
    x, y = point[0] * inverse % P, point[1] * inverse % P
    return (y | (x & 1) << 255).to_bytes(32, "little")


def _unpacked(data: bytes) -> Point | None:
    number = int.from_bytes(data, "little")
    y, odd = number & ((1 << 255) - 1), number >> 255
    x = _x_of(y, odd) if y < P else None
    return None if x is None else (x, y, 1, x * y % P)


def _number(*parts: bytes) -> int:
    return int.from_bytes(hashlib.sha512(b"".join(parts)).digest(), "little")


def _secret(seed: bytes) -> tuple[int, bytes]:
    digest = hashlib.sha512(seed).digest()
    return int.from_bytes(digest[:32], "little") & ((1 << 254) - 8) | 1 << 254, digest[32:]


def new_seed() -> bytes:
    return os.urandom(32)


def public_key(seed: bytes) -> bytes:
    return _packed(_times(_secret(seed)[0], BASE))


def sign(seed: bytes, message: bytes) -> bytes:
    scalar, prefix = _secret(seed)
    own = public_key(seed)
    once = _number(prefix, message) % ORDER
    point = _packed(_times(once, BASE))
    return point + ((once + _number(point, own, message) * scalar) % ORDER).to_bytes(32, "little")


def verify(public: bytes, message: bytes, signature: bytes) -> bool:
    if len(public) != 32 or len(signature) != 64:
        return False
    key, point, s = _unpacked(public), _unpacked(signature[:32]), int.from_bytes(signature[32:], "little")
    if key is None or point is None or s >= ORDER:
        return False
    left, right = _times(s, BASE), _add(point, _times(_number(signature[:32], public, message) % ORDER, key))
    return (left[0] * right[2] - right[0] * left[2]) % P == 0 and (left[1] * right[2] - right[1] * left[2]) % P == 0


def _pem(kind: str, body: bytes) -> str:
    return f"-----BEGIN {kind} KEY-----\n{base64.b64encode(body).decode()}\n-----END {kind} KEY-----\n"


def private_pem(seed: bytes) -> str:
    return _pem("PRIVATE", PRIVATE_HEAD + seed)


def public_pem(public: bytes) -> str:
    return _pem("PUBLIC", PUBLIC_HEAD + public)


def read_pem(text: str) -> bytes:
    """The 32 bytes of a key in a PEM file of either kind."""
    body = base64.b64decode("".join(x for x in text.split("\n") if not x.startswith("-----")))
    for head in (PRIVATE_HEAD, PUBLIC_HEAD):
        if body.startswith(head) and len(body) == len(head) + 32:
            return body[len(head) :]
    raise ValueError("not an Ed25519 key")
