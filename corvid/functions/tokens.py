"""Bearer-token claims as Column expressions.

A token is ``header.payload.signature`` with base64url segments and JSON
claims. The signature is not checked: this is for auditing which account a
token names, never for authorising anything. A malformed token yields null
claims instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType)

# Fixed value: claims of a cluster service-account token. The dotted key is a
# single JSON field name.
_NAME_UID = StructType([StructField("name", StringType()), StructField("uid", StringType())])
SERVICE_ACCOUNT_CLAIMS = StructType([
    StructField("aud", ArrayType(StringType())),
    StructField("exp", LongType()),
    StructField("iat", LongType()),
    StructField("iss", StringType()),
    StructField("nbf", LongType()),
    StructField("sub", StringType()),
    StructField("kubernetes.io", StructType([
        StructField("namespace", StringType()),
        StructField("pod", _NAME_UID),
        StructField("serviceaccount", _NAME_UID),
        StructField("warnafter", LongType()),
    ])),
])
DEFAULT_ACCOUNT = "default"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _replaced(text: Column, parts: dict[str, str]) -> Column:
    """Plain replacements one by one: ``translate`` and patterns look up every character."""
    for old, new in parts.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def base64url_decode(segment: Column) -> Column:
    """base64url text without padding -> binary; null when invalid."""
    padded = F.concat(_replaced(segment, {"-": "+", "_": "/"}),
                      F.repeat(F.lit("="), F.pmod(-F.length(segment), F.lit(4))))
    return F.try_to_binary(padded, F.lit("base64"))


def base64url_encode(data: Column) -> Column:
    """binary or text -> base64url text without padding (``base64`` may wrap
    long output in lines; the breaks are removed)."""
    return F.rtrim(_replaced(F.base64(data), {"+": "-", "/": "_", "\r\n": ""}), F.lit("="))


def token_payload(token: Column | str) -> Column:
    """The middle segment decoded to JSON text; null unless there are exactly three segments."""
    t = _col(token)
    dots = F.length(t) - F.length(F.replace(t, F.lit("."), F.lit("")))
    return F.when(dots == 2, base64url_decode(F.substring_index(F.substring_index(t, ".", 2), ".", -1)).cast("string"))


def token_claims(token: Column | str, schema: StructType = SERVICE_ACCOUNT_CLAIMS) -> Column:
    """Claims struct of a token (signature not verified)."""
    return F.from_json(token_payload(token), schema)


# Only what an audit of accounts needs is read from the payload.
_ACCOUNT = StructType([StructField("kubernetes.io", StructType([
    StructField("serviceaccount", StructType([StructField("name", StringType())]))]))])


def account_claim(token: Column | str) -> Column:
    """The account object of a cluster token: struct<name>; null when it or the token is missing."""
    return F.from_json(token_payload(token), _ACCOUNT)["kubernetes.io"]["serviceaccount"]


def account_name(claim: Column) -> Column:
    """Name of an account object; ``default`` when it carries none."""
    return F.when(claim.isNotNull(), F.coalesce(claim["name"], F.lit(DEFAULT_ACCOUNT)))


def service_account(token: Column | str) -> Column:
    """Account name claimed by a cluster token; ``default`` when the account
    object carries no name; null when the token or the account object is missing."""
    return account_name(account_claim(token))


def encode_token(header_json: Column, payload_json: Column, signature: Column) -> Column:
    """Assemble ``header.payload.signature`` from JSON text and signature bytes."""
    return F.concat_ws(".", base64url_encode(header_json), base64url_encode(payload_json),
                       base64url_encode(signature))
