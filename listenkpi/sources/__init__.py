"""Sources and sinks: driver tables as domain views, CSV folders, staged and keyed outputs."""
