"""From a data directory to result files: configuration, data checks, the staged run, the keyed run, the command."""
