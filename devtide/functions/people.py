"""Who did it: contributor records derived from payloads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the fields of a person are read from: a column of text or of a number by path.
Reader = Callable[[str], Column]

PERSON_FIELDS = (
    "contributor_nk",
    "github_user_id",
    "login",
    "display_name",
    "user_type",
    "is_bot",
)

BOT_SUFFIX = "[bot]"

# White space that str.strip() removes and a regular expression's \s alone does not.
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _person(nk: Column, uid: Column, login: Column, name: Column, kind: Column, bot: Column):
    return F.struct(
        nk.alias("contributor_nk"),
        uid.cast("bigint").alias("github_user_id"),
        login.cast("string").alias("login"),
        name.alias("display_name"),
        kind.alias("user_type"),
        bot.alias("is_bot"),
    )


def _filled(text: Column) -> Column:
    return F.when(text != "", text)


def account_fields(path: str, prefix: str, text: Reader, long: Reader) -> dict[str, Column]:
    """The fields of an account object, to be projected before they are used."""
    return {
        f"{prefix}_login": text(f"{path}.login"),
        f"{prefix}_id": long(f"{path}.id"),
        f"{prefix}_type": text(f"{path}.type"),
    }


def identity_fields(path: str, prefix: str, text: Reader) -> dict[str, Column]:
    """The fields of a name/e-mail pair, to be projected before they are used."""
    return {
        f"{prefix}_email": text(f"{path}.email"),
        f"{prefix}_name": text(f"{path}.name"),
    }


def linked_account(prefix: str) -> Column:
    """Contributor of an account; NULL without a login."""
    login = F.col(f"{prefix}_login")
    kind = F.coalesce(_filled(F.col(f"{prefix}_type")), F.lit("User"))
    person = _person(
        F.concat(F.lit("gh:"), F.lower(login)),
        F.col(f"{prefix}_id"),
        login,
        login,
        kind,
        (kind == "Bot") | login.endswith(BOT_SUFFIX),
    )
    return F.when(login != "", person)


def git_identity(prefix: str) -> Column:
    """Contributor of a bare name/e-mail pair. Only a hash of the e-mail is kept."""
    email, name = F.col(f"{prefix}_email"), F.col(f"{prefix}_name")
    stripped = F.regexp_replace(email, f"^{_BLANK}+|{_BLANK}+$", "")
    basis = F.coalesce(
        _filled(F.lower(stripped)),
        F.concat(F.lit("name:"), F.coalesce(name, F.lit("None"))),
    )
    display = F.coalesce(_filled(name), F.lit("unknown"))
    person = _person(
        F.concat(F.lit("git:"), F.substring(F.sha2(basis, 256), 1, 16)),
        F.lit(None),
        F.lit(None),
        display,
        F.lit("Unlinked"),
        display.endswith(BOT_SUFFIX),
    )
    return F.when((email != "") | (name != ""), person)


def commit_person_fields(role: str, text: Reader, long: Reader) -> dict[str, Column]:
    account = account_fields(role, f"_{role}", text, long)
    return account | identity_fields(f"commit.{role}", f"_{role}", text)


def commit_person(role: str) -> Column:
    """The linked account of a commit role, else its git identity."""
    return F.coalesce(linked_account(f"_{role}"), git_identity(f"_{role}"))


def contributor_key(nk: Column) -> Column:
    """Surrogate key: a hash of the natural key, so no lookup join is needed."""
    return F.xxhash64(nk)
