"""DataFrame-to-DataFrame operators that carry no knowledge of the layers."""
