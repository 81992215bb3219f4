"""grainmill.sources"""
