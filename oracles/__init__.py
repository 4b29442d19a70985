"""Every operator's result stated as SQL over the driver's tables."""

from oracles import raw, star

ORACLES: dict[str, str] = {**raw.ORACLES, **star.ORACLES}
