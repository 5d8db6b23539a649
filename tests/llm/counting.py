"""Ranks that tell who goes through them. Python workers import this."""

import os


class CountedRanks(dict):
    """Logs the process of each pass."""

    log = os.devnull

    def items(self):
        with open(self.log, "a") as file:
            file.write(f"{os.getpid()}\n")
        return dict.items(self)
