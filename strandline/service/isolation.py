"""Run a command in a process of its own, with a deadline that holds whatever it does."""

from __future__ import annotations

import subprocess

GRACE_SECONDS = 1.0


class Killed(RuntimeError):
    """The deadline passed and the process was ended."""


def isolated(command: list[str], timeout_seconds: float, **how) -> subprocess.CompletedProcess:
    """The finished process; past the deadline it is asked to end, then made to, and Killed is raised."""
    p = subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, **how)
    try:
        out, err = p.communicate(timeout=timeout_seconds)
    except subprocess.TimeoutExpired:
        p.terminate()
        try:
            p.communicate(timeout=GRACE_SECONDS)
        except subprocess.TimeoutExpired:
            p.kill()
            p.communicate()
        raise Killed("the query took too long") from None
    return subprocess.CompletedProcess(command, p.returncode, out, err)
