"""A cap on deletes over all stages of a run."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Budget:
    """cap None: unlimited.  A spent budget lets later stages delete nothing."""

    cap: int | None = None
    used: int = 0

    @property
    def remaining(self) -> int | None:
        return None if self.cap is None else max(0, self.cap - self.used)

    @property
    def exhausted(self) -> bool:
        return self.remaining == 0

    def spend(self, n: int) -> Budget:
        return replace(self, used=self.used + n)


def of_setting(most: int) -> Budget:
    """A setting of 0 or less means unlimited."""
    return Budget(most if most > 0 else None)
