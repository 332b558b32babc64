"""Model settings: penalties, and the tag stages in the order they are fitted."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Stage:
    """One tag effect per user over the rows whose tag text contains ``token``."""

    name: str
    token: str
    penalty: float = 0.0


@dataclass(frozen=True)
class Spec:
    """A penalty of 0 is the plain mean."""

    name: str
    item_penalty: float
    user_penalty: float
    stages: tuple[Stage, ...]

    @property
    def tokens(self) -> tuple[str, ...]:
        return tuple(stage.token for stage in self.stages)


def unpenalised(spec: Spec, name: str = "plain") -> Spec:
    """The plain model of the same tags; its first two stages change places."""
    plain = [replace(stage, penalty=0.0) for stage in spec.stages]
    plain[:2] = plain[1::-1]
    return Spec(name, 0.0, 0.0, tuple(plain))


# Stage names, tokens and penalties of the published film-rating model.
FILM_STAGES = (
    Stage("drama", "Drama", 27.0),
    Stage("comedy", "Comedy", 32.0),
    Stage("action", "Action", 11.0),
    Stage("thriller", "Thriller", 36.0),
    Stage("adventure", "Adventure", 27.0),
    Stage("romance", "Romance", 31.0),
    Stage("sci", "Sci", 25.0),
    Stage("crime", "Crime", 25.0),
    Stage("fantasy", "Fantasy", 25.0),
    Stage("children", "Children", 7.0),
    Stage("horror", "Horror", 9.0),
    Stage("mystery", "Mystery", 62.0),
    Stage("war", "War", 28.0),
    Stage("animation", "Animation", 11.0),
    Stage("musical", "Musical", 16.0),
    Stage("western", "Western", 20.0),
    Stage("film", "Film", 9.0),
    Stage("documentary", "Documentary", 4.0),
    Stage("imax", "IMAX", 5.5),
)
ITEM_PENALTY = 1.75
USER_PENALTY = 5.0

FILM_SHRUNK = Spec("shrunk", ITEM_PENALTY, USER_PENALTY, FILM_STAGES)
FILM_PLAIN = unpenalised(FILM_SHRUNK)

# The tags of the generated test tables take the published penalties in turn.
VIEW_TOKENS = (
    "ECONOMY LARGE MEDIUM PROMO SMALL STANDARD anvil blue bolt cold gear gizmo "
    "hot large new old plate red ring rod small widget"
).split()

VIEW_SHRUNK = Spec(
    "shrunk",
    ITEM_PENALTY,
    USER_PENALTY,
    tuple(
        Stage(token, token, FILM_STAGES[i % len(FILM_STAGES)].penalty)
        for i, token in enumerate(VIEW_TOKENS)
    ),
)
VIEW_PLAIN = unpenalised(VIEW_SHRUNK)
