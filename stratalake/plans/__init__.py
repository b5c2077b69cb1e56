"""The layers and the reports on them, each a declarative plan over the layer above."""
